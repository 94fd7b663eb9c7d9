"""Vector searches against brute force."""

import numpy as np

from gristmill.llm import vectors

ROWS = "vec_id long, embedding array<float>, label int"


def data(n=1200, dim=24, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[300:700] = x[300]  # a third are one vector
    return x


def frame(spark, x, more=()):
    return spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)] + list(more), ROWS)


BAD = [(None, [1.0] * 24, 0), (5000, None, 0), (5001, [None] * 24, 0), (5002, [float("nan")] * 24, 0), (5003, [float("inf")] * 24, 0), (5004, [], 0), (5050, [1.0, 2.0], 0)]


def test_exact_topk(spark):
    x = data()
    got = {}
    for r in vectors.exact_topk(frame(spark, x, [*BAD, (3, x[3].tolist(), 0), (50, x[50].tolist(), 1)])).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    z = np.floor(256 * x.astype(float)).astype(int)
    assert set(got) == set(range(0, 1200, 50))
    for q, rows in got.items():
        s = z @ z[q]
        best = sorted((i for i in [*range(len(z)), 3, 50] if i != q), key=lambda i: (-s[i], i))[:5]
        assert sorted(rows) == [(k + 1, i, s[i]) for k, i in enumerate(best)]


def test_few_candidates_and_large_numbers(spark):
    df = spark.createDataFrame([(0, [1e12, 3.0], 0), (1, [2e12, 1.0], 0), (2, [-1.0, 0.5], 0)], "vec_id long, embedding array<double>, label int")
    rows = vectors.exact_topk(df).collect()
    assert [(r.vec_id, r["rank"]) for r in rows] == [(1, 1), (2, 2)] and rows[0].score == 2**63 - 1
    assert rows[1].score == -256 * 256 * 10**12 + 128 * 768
    assert vectors.exact_topk(df.limit(0)).count() == 0 and vectors.nearest(df.limit(0)).count() == 0


def test_nearest_recall_and_scores(spark):
    x = data(3000, 64, 3)
    got = {}
    for r in vectors.nearest(frame(spark, x, [*BAD, (6000, [0.0] * 64, 0)]), every=20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    y = x.astype(float)
    hits = 0
    assert set(got) == set(range(0, 3000, 20))
    for q, rows in got.items():
        d = np.sqrt(((y - y[q]) ** 2).sum(1))
        best = sorted((i for i in range(len(y)) if i != q), key=lambda i: (d[i], i))[:10]
        hits += len(set(best) & {i for _, i, _ in rows})
        assert [k for k, _, _ in sorted(rows)] == list(range(1, 11))
        assert all(s == d[i] for _, i, s in rows) and [s for *_, s in sorted(rows)] == sorted(s for *_, s in rows)
    assert hits / (10 * len(got)) >= 0.95


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x = np.floor(rng.standard_normal((50, 30)) * 99)
    for s in (1, 4, 7, 15):
        m = vectors.segment_statistics(x, s)
        assert (m @ m.T >= x @ x.T - 1e-6).all()


def test_few_vectors_are_verified():
    """Recall of the neighbours in one block, and the share of it whose distances are computed."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 64))
    for x, most in ((rng.standard_normal((8192, 64)), 0.35), (centres[rng.integers(0, 40, 8192)] + 0.2 * rng.standard_normal((8192, 64)), 0.1)):
        search, hit, verified = vectors._collision_search(10)(np.arange(len(x)), x), 0, 0
        for i in range(0, len(x), 200):
            _, found = search(i, x[i])
            far = np.sort(np.delete(((x - x[i]) ** 2).sum(1), i))[:10]
            hit += (found**2 <= far[-1] + 1e-9).sum()
            verified += search.verified
        asked = len(range(0, len(x), 200))
        assert hit >= 0.95 * 10 * asked and verified <= most * asked * len(x)
