"""Mixing: targets against repeated resharing, words near targets."""

import hashlib
import math
import random

from pyspark.sql import functions as F

from gristmill.llm import mixing

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def reshared(sizes, weights, share, cap):
    """Targets by resharing the excess until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        each = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        above = {s for s in open_ if each[s] > cap * sizes[s] + 1e-9}
        if not above:
            return target | each
        for s in above:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= above
    return target


def docs(n=3000):
    rng = random.Random(9)
    names = ["a", "b", "é", "Z", "😀", None]
    return [(i, " ".join(["w"] * int(rng.lognormvariate(4, 1))), "en", rng.choices(names, [40, 5, 5, 20, 5, 3])[0], 1) for i in range(n)]


def test_targets_and_taken(spark):
    rows = docs()
    df = spark.createDataFrame(rows, DOCS)
    got = mixing.mixed(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want, taken = reshared(sizes, (3, 1, 2), 1.5, 2.0), {}
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(0.01 * want[s], 3)
    again = {(r.doc_id, r.taken) for r in mixing.mixed(df.repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in got}
    copies = mixing.take(df)
    assert copies.columns == df.columns
    assert copies.agg(F.sum(F.size(F.split("text", " ")))).first()[0] == sum(taken.values())


def test_nulls_ties_and_empty(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, "a b", "en", "a", 3), (2, "a b", "en", "a", 3), (None, "c d", None, "b", 1)]
    got = mixing.mixed(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == 5 and all(0 <= r.taken <= 2 * r.size for r in got)
    assert {(r.source, r.target) for r in got if r.source is None} == {(None, 0.0)}
    assert mixing.mixed(spark.createDataFrame([], DOCS)).count() == 0
    assert mixing.take(spark.createDataFrame([], DOCS)).count() == 0


def expected(sizes, target, cap=2.0, half=64):
    """Expected copies of each size by halving the range of the factor."""
    weight = {z: z / (z + half) for z in sizes if z}
    lo, hi = 0.0, cap * (1 + half)
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(z * min(cap, mid * weight[z]) for z in sizes if z) < target else (lo, mid)
    return {z: min(cap, hi * weight[z]) if z else 0.0 for z in sizes}


def test_long_documents_are_set_aside(spark):
    """Sources with one very long document among short ones end as a loop down the ranks does, near their targets."""
    rng = random.Random(4)
    rows = [(1000 * s + i, " ".join(["w"] * (20000 if i == 0 else rng.randint(50, 300))), "en", f"s{s:02d}", 1) for s in range(12) for i in range(401)]
    got = mixing.mixed(spark.createDataFrame(rows, DOCS).repartition(4), weights=(1,), share=1.5, cap=2.0).collect()
    by_source = {}
    for r in got:
        by_source.setdefault(r.source, []).append(r)
    for mine in by_source.values():
        copies = expected([r.size for r in mine], mine[0].target)
        assert all(abs(copies[r.size] - r.expected) < 1e-6 for r in mine)
        odd = {r.doc_id: r.expected - math.floor(r.expected) for r in mine}
        u = {r.doc_id: (int(hashlib.md5(f"{r.doc_id}:0".encode()).hexdigest()[:13], 16) + 0.5) / 2**52 for r in mine}
        gap, taken = mine[0].target - sum(math.floor(r.expected) * r.size for r in mine), set()
        ranked = sorted((r for r in mine if odd[r.doc_id] > 0), key=lambda r: u[r.doc_id] / (1 - u[r.doc_id]) / (odd[r.doc_id] / (1 - odd[r.doc_id])))
        for r in ranked:
            if r.size <= gap:
                gap -= r.size
                taken.add(r.doc_id)
        least = min((r for r in ranked if r.doc_id not in taken), key=lambda r: r.size)
        assert gap < least.size
        if least.size - gap < gap:
            taken.add(least.doc_id)
        assert {r.doc_id for r in mine if r.copies > math.floor(r.expected)} == taken
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= least.size / 2


def test_documents_are_included_by_their_own_odds(spark):
    """Sources of the same sizes: the share of each size that the sample takes is its inclusion probability, but for the few
    small documents that fill the last gap."""
    sizes = [30] * 150 + [60] * 150 + [90] * 150 + [120] * 150 + [150] * 150
    rows = [(1000 * s + i, " ".join(["w"] * z), "en", f"s{s:03d}", 1) for s in range(10) for i, z in enumerate(sizes)]
    got = mixing.mixed(spark.createDataFrame(rows, DOCS), weights=(1,), share=1.4, cap=2.0).collect()
    seen = {}
    for r in got:
        seen.setdefault(r.size, []).append(r.copies)
    want = expected(sizes, 1.4 * sum(sizes))
    assert len({round(want[z], 3) for z in seen}) == 5
    for z, copies in seen.items():
        assert abs(sum(copies) / len(copies) - want[z]) < 0.05


def test_repeats_and_clashing_names(spark):
    kind = "doc_id long, text string, source string, _row int, mark int, s string"
    rows = [(1, "a b c", "x", 1, 1, "p"), (1, "a b c", "y", 1, 1, "p"), (1, "a b c", "y", 1, 1, "p"), (2, "d " * 90_000, "x", None, 2, None)]
    df = spark.createDataFrame(rows, kind)
    got = mixing.take(df, weights=(1,), share=2.0, cap=2.0)
    assert got.columns == df.columns
    assert sorted(map(str, got.collect())) == sorted(str(r) for r in df.union(df).collect())
