"""Near-duplicates against all pairs of full sets."""

import random
import re

import numpy as np
import pytest

from gristmill.llm import near_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * len(sets[a] | sets[b]):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def texts():
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(500)]
    out = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 12, 60, 150]))]
        out.append(" ".join(base))
        for _ in range(rng.randrange(6)):  # chains of small changes: components wider than one link
            for _ in range(rng.randrange(4)):
                base[rng.randrange(len(base))] = rng.choice(vocabulary)
            out.append("\t".join(base).upper() if rng.random() < 0.3 else " \n".join(base))
    return [*out, "", "  \n", None, "one", "ONE", "one two", "Äb cd", "äb cd", "long " * 20_000, "x" * 100_000]


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_matches_all_pairs(spark, k, percent):
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts())]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS).repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df, k, percent).collect()}
    assert got == brute(rows, k, percent)


def test_links_behind_the_leader(spark):
    """A large group in which many copies are too far from any one of them."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for j in range(rng.randrange(0, 9)):
            words[rng.randrange(120)] = f"u{i}_{j}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df, 3, 85).collect()}
    assert got == brute(rows, 3, 85)


def test_nulls_repeats_and_other_columns(spark):
    text = "a b c d e f g"
    df = spark.createDataFrame([(5, text, 1), (5, text, 1), (None, text, 2), (3, text, 3), (8, None, 4)], "doc_id long, text string, digest int")
    rows = sorted(map(tuple, near_dedup.near_duplicates(df, 3, 85).collect()), key=str)
    assert rows == sorted([(5, 5, 3, False), (5, 5, 3, False), (None, 5, None, True), (3, 5, 3, True), (8, 0, 8, True)], key=str)
    kept = near_dedup.one_of_each(df, 3, 85)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 3, 8]
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def test_unlike_texts_under_one_id_stay_and_names_may_clash(spark):
    rows = [(1, "a b c d e f g", "s", 1), (1, "p q r s t u v", "t", 2), (1, "p q r s t u v", "t", 3), (2, "P q r s t u v", "u", 4), (3, "", None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _kept string, _key int")
    got = sorted(map(tuple, near_dedup.one_of_each(df, 3, 85).collect()))
    assert near_dedup.one_of_each(df, 3, 85).columns == df.columns
    assert got == [(1, "a b c d e f g", "s", 1), (1, "p q r s t u v", "t", 2), (3, "", None, 5)]


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 2**63, 3000, dtype=np.uint64), rng.integers(0, 2**63, 3000, dtype=np.uint64)
    ra, rb, both = (near_dedup.registers(x, np.array([0, len(x)]), 512)[0] for x in (a, b, np.r_[a, b]))
    assert (np.maximum(ra, rb) == both).all()
    near = near_dedup.registers(np.r_[a[:2800], b[:200]], np.array([0, 3000]), 512)[0]
    size = np.array([3000])
    assert near_dedup.plausible(ra[None], near[None], size, size, 85)[0]
    assert not near_dedup.plausible(ra[None], rb[None], size, size, 85)[0]
