"""Packing against a plain search over all bins."""

import random
from collections import Counter, defaultdict

from gristmill.llm import packing

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain(sizes, sources, clusters, capacity):
    bins, out = [], []
    for size, s, c in zip(sizes, sources, clusters, strict=True):
        fits = [(room, i) for i, (room, ss, cc) in enumerate(bins) if room >= size and not ss & s and not cc & c]
        if fits:
            room, i = min(fits)
            bins[i] = (room - size, bins[i][1] | s, bins[i][2] | c)
        else:
            i = len(bins)
            bins.append((capacity - size, s, c))
        out.append(i)
    return out


def test_best_fit_is_the_tightest_compatible_bin():
    rng = random.Random(2)
    for _ in range(30):
        n = rng.randrange(1, 120)
        sizes = sorted((rng.randrange(1, 40) for _ in range(n)), reverse=True)
        sources = [rng.choice([0, 1, 1, 2, 4, 8]) for _ in range(n)]
        clusters = [rng.choice([0, 0, 1, 2, 4]) for _ in range(n)]
        assert packing.best_fit(sizes, sources, clusters, 64) == plain(sizes, sources, clusters, 64)


def test_packed(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 9, 30, 47])), "en", rng.choice(["a", "b", "c", None]), 1) for i in range(300)]
    docs += [docs[3], docs[3], (None, "x y", None, None, None), (301, None, None, "a", None)]
    df = spark.createDataFrame(docs, DOCS)
    rows = packing.packed(df, capacity=20, cluster_col="doc_id").collect()
    words, bins = Counter(), defaultdict(list)
    for r in rows:
        words[r.doc_id, r.copy] += r.words
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    want = Counter()
    for i, t, *_ in docs:
        want[i] += len((t or "").split())
    assert sum(words.values()) == sum(want.values()) and all(sum(n for (i, _), n in words.items() if i == d) == want[d] for d in want)
    for held in bins.values():
        held.sort(key=lambda r: r.bin_offset)
        assert sum(r.words for r in held) <= 20
        assert [r.bin_offset for r in held] == [sum(x.words for x in held[:k]) for k in range(len(held))]
        rest = [r for r in held if r.words < 20]
        assert len({r.source for r in rest if r.source}) == len([r for r in rest if r.source])
        assert len({r.doc_id for r in held}) == len(held)
    assert len(bins) < len(rows)
    unique = df.dropDuplicates(["doc_id"]).where("doc_id is not null")
    pieces = packing.packed(unique, capacity=20)
    texts = packing.bin_texts(pieces, unique).collect()
    assert sum(len(r.text.split()) for r in texts) == sum(r.words for r in pieces.collect())
    assert packing.packed(df.limit(0)).count() == 0


def test_copies_in_one_source_stay_apart(spark):
    df = spark.createDataFrame([(i, "same text here", "en", None, 1) for i in range(50)], DOCS)
    assert packing.packed(df, capacity=100).select("bin_id").distinct().count() == 50


def test_repeated_rows_are_dealt_over_shards_and_long_texts_are_cut(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 64)
    rows = [(7, "one two three", "en", "a", 1)] * 1000 + [(8, "w " * 100_000, "en", "b", 1)]
    got = packing.packed(spark.createDataFrame(rows, DOCS), capacity=50, cluster_col="doc_id").collect()
    of = [r for r in got if r.doc_id == 7]
    assert sorted(r.copy for r in of) == list(range(1000)) and len({r.bin_id for r in of}) == 1000
    assert max(Counter(r.bin_id >> 32 for r in of).values()) < 150
    long = sorted((r for r in got if r.doc_id == 8), key=lambda r: r.piece)
    assert [r.word_start for r in long] == list(range(0, 100_000, 50)) and all(r.words == 50 for r in long)
