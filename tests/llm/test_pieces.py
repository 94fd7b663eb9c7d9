"""Encoding and decoding against the library that the model was made for."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from gristmill.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["▁", " ", "  ", "a", "aa", "th", "he", "in", "é", "é", "漢", "字", "🙂", "\n", "\t", "\x00", "1", "12", "ing", "ction", "가", "ᄀ", "ﬁ", "①", "<s>", "<unk>", "<0x41>", "﻿", "�"]


@pytest.fixture(scope="module")
def own():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(MODEL)


def texts(vocabulary):
    rng, some = random.Random(2), list(vocabulary.order)
    out = ["", " ", "▁", *(" " * k for k in range(1, 70)), *("a" * k for k in range(1, 90)), *("▁a" * k for k in range(1, 9))]
    out += ["".join(rng.choices(ODD, k=rng.randrange(60))) for _ in range(3000)]
    return out + ["".join(rng.choices(some, k=rng.randrange(20))) for _ in range(3000)] + ["漢字a" * 3000 + "x" * 3000, "word " * 50_000]


def test_texts(own, vocabulary):
    given = texts(vocabulary)
    encoder, decoder, got = pieces.Encoder(vocabulary), pieces.Decoder(vocabulary), []
    for t in given:
        encoder.encode(t, ids := [])
        got.append(ids)
    want = own.encode(given)
    assert [t for t, a, b in zip(given, got, want, strict=True) if a != b] == []
    back = _decoded(decoder, got)
    assert back == own.decode(want)
    # merging by the definition gives the same pieces
    for t in given[200:500]:
        if t:
            merged = vocabulary.merged("▁" + t.replace(" ", "▁"))
            assert sum(([vocabulary.ids[p]] if p in vocabulary.ids else [vocabulary.bytes_[b] for b in p.encode()] for p in merged), []) == own.encode(t)


def _decoded(decoder, lists):
    begin = np.cumsum([0, *map(len, lists)])
    ids = np.array([i for x in lists for i in x], np.int64)
    data, at, size = decoder.decode(ids, begin)
    data = data.tobytes()
    return [decoder.sound(ids[i:j], size[i:j], data[x:y]).decode() for i, j, x, y in zip(begin[:-1], begin[1:], at[:-1], at[1:], strict=True)]


def test_any_ids(own, vocabulary):
    rng = random.Random(4)
    kinds = [lambda: rng.randrange(32000), lambda: rng.randrange(259), lambda: 28705, lambda: rng.randrange(3)]
    lists = [[rng.choice(kinds)() for _ in range(rng.randrange(12))] for _ in range(6000)]
    assert _decoded(pieces.Decoder(vocabulary), lists) == own.decode(lists)


def test_pairs_that_fail_are_given_up(vocabulary):
    """Longest matches alone are wrong somewhere, so that backtracking is used."""
    encoder, rng, wrong = pieces.Encoder(vocabulary), random.Random(1), 0
    some = [p for p in vocabulary.order if p.isascii()]
    for _ in range(2000):
        text = "".join(rng.choices(some, k=4))
        got = encoder.backtracked(text)
        assert [vocabulary.pieces[i] for i in got] == vocabulary.merged(text)
        greedy, at = [], 0
        while at < len(text):
            n = max(n for n in range(1, 17) if text[at : at + n] in vocabulary.order)
            greedy.append(vocabulary.ids[text[at : at + n]])
            at += n
        wrong += greedy != got
    assert wrong > 100


def test_columns(spark, own):
    rows = [(1, None, 1, "x"), (2, "", 2, "y"), (3, "Ein Wort\n①", 3, None), (3, "Ein Wort\n①", 3, None), (None, " a" * 30_000, 4, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, `0` int, `a.b` string")
    carried = pieces.encoded(df, MODEL)
    assert carried.columns == ["doc_id", "text", "0", "a.b", "ids"]
    back = pieces.decoded(carried, MODEL)
    for r in back.collect():
        assert r.ids == own.encode(r.text or "") and r.decoded == (r.text or "")
    assert pieces.decoded(spark.createDataFrame([(None,), ([],), ([264, 1, 259],)], "ids array<int>"), MODEL).orderBy("decoded").toPandas().decoded.tolist() == [None, "", "a  "]
    got = pieces.report(df, MODEL).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(i, len(ids := own.encode(t or "")), sha(",".join(map(str, ids))), sha(t or "")) for i, t, _, _ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert pieces.report(df.limit(0), MODEL).count() == 0
    with pytest.raises(ValueError):
        pieces.encoded(df, MODEL, into="TEXT")


def test_no_piece_is_cut(vocabulary):
    """Stretches join to the text, and every piece is one stretch, also behind and before other pieces that it merges with."""
    cut = pieces.Encoder(vocabulary).stretches
    assert [p for p in vocabulary.whole if cut(p) != [p]] == []
    rng, some = random.Random(3), list(vocabulary.order)
    for _ in range(3000):
        text = "".join(rng.choices(some + ODD, k=6)).replace(" ", "▁")
        assert "".join(cut(text)) == text
    assert len(cut("▁Well,▁it's▁3.\nYes")) > 6
    assert pieces._stretches({"a", "b", "ab", "a▁b", "▁"}) == "(?s).+"
    assert pieces._stretches({"a", ".", "a.", "▁"}).count("\\.") == 0  # a letter and a mark in one piece are one kind
