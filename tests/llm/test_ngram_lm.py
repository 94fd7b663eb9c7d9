"""Language-model scores against a plain Kneser-Ney model in dictionaries."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from gristmill.llm import ngram_lm

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "</s>"]


def plain(rows, order):
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    top, count = Counter(), Counter()
    grams = lambda w: zip(*[(["<s>"] * (order - 1) + w)[k:] for k in range(order)], strict=False)
    for i, t in rows:
        if not held[i]:
            w = tokens(t)
            count.update(w)
            top.update(grams(w))
    n, v = sum(count.values()), len(count)
    values = {order: top}
    for k in range(order - 1, 0, -1):
        values[k] = Counter(g[1:] for g in values[k + 1])
    of = lambda counts: ngram_lm.discounts(*[sum(x == k for x in counts) for k in (1, 2, 3, 4)])
    off = {k: of(values[k].values()) for k in values}
    d = lambda c, x: 0 if not c else x[min(c, 3) - 1]
    after = {k: defaultdict(list) for k in values}
    for k in values:
        for g, c in values[k].items():
            after[k][g[:-1]].append(c)

    def p(*g):
        k = len(g)
        lower = p(*g[1:]) if k > 1 else 1 / (v + 1)
        seen = after[k].get(g[:-1])
        if not seen:
            return lower
        c = values[k][g]
        return (max(c - d(c, off[k]), 0) + spare[k][g[:-1]] * lower) / total[k][g[:-1]]

    total = {k: {c: sum(x) for c, x in after[k].items()} for k in values}
    spare = {k: {c: sum(d(y, off[k]) for y in x) for c, x in after[k].items()} for k in values}
    out = []
    for i, t in rows:
        w = tokens(t)
        base = sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        out.append((i, held[i], len(w), sum(count[x] > 0 for x in w), n, base, sum(math.log10(p(*g)) for g in grams(w))))
    return out, p, count


def close(a, b):
    return a[:5] == b[:5] and all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(a[5:], b[5:], strict=True))


def rows_of(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in docs] + [(9001, None), (9002, ""), (None, "Is IS is is"), (9003, "a " * 3000), (9003, "a " * 3000)]


@pytest.mark.parametrize(("order", "files"), [(2, 128), (2, 2), (3, 3)])
def test_scores_match_plain_model(spark, monkeypatch, order, files):
    monkeypatch.setattr(ngram_lm, "SHARD_CHARS", 60_000)  # many shards and ranges
    monkeypatch.setattr(ngram_lm, "GATHER_BYTES", 200_000)
    monkeypatch.setattr(ngram_lm, "FILES", files)
    rows = rows_of(spark)
    got = ngram_lm.report(spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS).repartition(4), order).collect()
    want, p, count = plain(rows, order)
    assert len(got) == len(want)
    key = lambda r: (str(r[0]), r[2], r[6])
    assert all(close(a, b) for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True))
    context = ("<s>", "the")[2 - order :] if order == 3 else ("the",)
    assert abs(sum(p(*context, w) for w in count) + p(*context, "no such word") - 1) < 1e-9
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # a better model than single words


def test_files_dont_grow_with_the_input(spark, monkeypatch, tmp_path):
    """Whatever the number of shards, a run of texts opens at most FILES arrays of each field of an order."""
    rows = [(i, t) for i, t in rows_of(spark) if i is not None]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    text = [t or "" for _, t in rows]
    monkeypatch.setattr(ngram_lm, "FILES", 4)
    scores, opened = [], []
    for chars in (200_000, 50_000, 12_000):
        monkeypatch.setattr(ngram_lm, "SHARD_CHARS", chars)
        model = ngram_lm.count(df, 2)
        mapped = ngram_lm.Mapped(model)
        for _, _, raw, offsets in ngram_lm.text_chunks(pa.array(text)):
            scores.append(mapped.score(*ngram_lm.word_hashes(raw, offsets))[3].sum())
        opened.append((model.shards, len(mapped.files)))
        # a joining task that comes again finds its work done
        parts = range(0, model.shards_a_file)
        if model.shards_a_file > 1:
            assert not any((tmp_path.__class__(model.folder) / f"2-{k:06d}.keys.npy").exists() for k in parts)
    assert opened[-1][0] > 8 * ngram_lm.FILES / 4 and max(n for _, n in opened) <= ngram_lm.FILES * (2 + 7)
    per = len(scores) // 3
    assert np.allclose(scores[:per], scores[per : 2 * per]) and np.allclose(scores[:per], scores[2 * per :])


def test_without_training_rows(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    got = ngram_lm.report(spark.createDataFrame([(i, "a b", None, None, None) for i in held], DOCS)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == 0.0 for r in got) and len(got) == 3
    assert ngram_lm.report(spark.createDataFrame([], DOCS)).count() == 0
