"""Order-dependent selections against the plain loops that define them, on random inputs."""

import random

from pyspark.sql import functions as F

from gristmill.config import Events
from gristmill.operators import events, greedy, ordering, sets, vectors


def test_two_key_dedupe(spark):
    rows, want = [], set()
    for case in range(60):  # many small cases in one job: keys and ids are apart
        rng, seen = random.Random(case), set()
        for k in range(rng.randint(1, 12)):
            i = case * 100 + k
            a = rng.choice([None, *range(4)])
            b = rng.choice([None, *range(4)])
            a, b = (None if a is None else f"{case}:{a}"), (None if b is None else f"{case}:{b}")
            rows.append((i, a, b))
            if not ({("a", a), ("b", b)} - {("a", None), ("b", None)}) & seen:
                want.add(i)
                seen |= {("a", a), ("b", b)} - {("a", None), ("b", None)}
    got = greedy.two_key_dedupe(spark.createDataFrame(rows, "seq long, a string, b string"), "seq", "a", "b")
    assert {r.seq for r in got.collect()} == want
    known = spark.createDataFrame([(0, "u1", "t1"), (1, "u2", "t1"), (2, "u2", "t3")], "seq long, a string, b string")
    assert {r.seq for r in greedy.two_key_dedupe(known, "seq", "a", "b").collect()} == {0, 2}
    assert greedy.two_key_dedupe(known.limit(0), "seq", "a", "b").count() == 0


def test_leaders_and_components(spark):
    nodes, edges, leader, root = [], [], {}, {}
    for case in range(40):
        rng = random.Random(case)
        ids = [case * 100 + k for k in range(rng.randint(2, 15))]
        pairs = {(a, b) for a in ids for b in ids if a < b and rng.random() < 0.2}
        nodes += ids
        edges += pairs
        heads = []
        for i in ids:
            found = next((h for h in heads if (h, i) in pairs), None)
            leader[i] = i if found is None else found
            heads += [i] if found is None else []
        group = {i: i for i in ids}
        for _ in ids:
            for a, b in pairs:
                group[a] = group[b] = min(group[a], group[b])
        root |= {i: group[i] for i in ids if any(i in p for p in pairs)}
    n, e = spark.createDataFrame([(i,) for i in nodes], "id long"), spark.createDataFrame(edges, "a long, b long")
    assert {r.id: r.leader for r in greedy.leaders(n, e).collect()} == leader
    assert {r.id: r.root for r in greedy.components(e).collect()} == root
    assert greedy.components(e.limit(0)).count() == 0 and greedy.leaders(n, e.limit(0)).where("id <> leader").count() == 0


def test_assign(spark):
    rng = random.Random(5)
    pairs = [(q, i, rng.randint(0, 6) / 10) for q in range(12) for i in range(9)]
    want, used_q, used_i = set(), set(), set()
    for s, q, i in sorted((-s, q, i) for q, i, s in pairs):
        if -s >= 0.25 and q not in used_q and i not in used_i:
            want.add((q, i, -s))
            used_q.add(q)
            used_i.add(i)
    got = vectors.assign(spark.createDataFrame(pairs, "q long, i long, sim double"), 0.25)
    assert {(r.q, r.i, r.sim) for r in got.collect()} == want


def test_round_robin(spark):
    rng = random.Random(2)
    rows = [(s, rng.choice([None, "", "k1", "k2", "x", "y"]), rng.choice([None, 0, 1, 2, 3, 9])) for s in range(80)]
    order, queues, rest = {"k2": 0, "k1": 1}, {}, []
    for r in rows:
        (queues.setdefault(r[1], []) if r[1] and r[2] else rest).append(r)
    lines = [sorted(queues[k], key=lambda r: r[2]) for k in sorted(queues, key=lambda k: order.get(k, 2))]
    want = [line[k] for k in range(80) for line in lines if k < len(line)] + rest
    got = ordering.round_robin(spark.createDataFrame(rows, "seq long, keyword string, rank int"), "keyword", "rank", "seq", ["k2", "k1"])
    assert [r.seq for r in got.orderBy("place").collect()] == [r[0] for r in want]


def test_similar_pairs_by_blocks(spark):
    rng = random.Random(9)
    held = {i: set(rng.sample([f"w{k}" for k in range(60)], rng.randint(1, 25))) for i in range(60)}
    sig = spark.createDataFrame([(i, w, 1) for i, ws in held.items() for w in ws], "id long, token string, df long")
    was, events.BLOCK = events.BLOCK, 16
    try:
        got = {(r.a, r.b): (r.shared, r.n_a, r.n_b) for r in events.similar_pairs(sig, Events()).collect()}
    finally:
        events.BLOCK = was
    want = {}
    for a in held:
        for b in held:
            s = len(held[a] & held[b])
            if a < b and s and (s / len(held[a] | held[b]) >= 0.15 or s / min(len(held[a]), len(held[b])) >= 0.5):
                want[a, b] = (s, len(held[a]), len(held[b]))
    assert got == want


def test_packs_and_pool(spark):
    n = spark.range(9).withColumnRenamed("id", "seq")
    assert [(r.pack, r.full) for r in ordering.packs(n, "seq").orderBy("seq").collect()] == [(0, True)] * 4 + [(1, True)] * 4 + [(2, False)]
    p = spark.createDataFrame([(0, "u", "x"), (1, "v", "m"), (2, "u", "y")], "seq long, url string, body string")
    assert [(r.seq, r.body) for r in sets.pool(p, "url", "seq").orderBy("seq").collect()] == [(0, "y"), (1, "m")]
    b = events.representatives(spark.createDataFrame([(1, 1, True, 900, 9.0), (2, 1, False, 10, 2.0), (3, 3, False, 5, 1.0)], "id long, leader long, caption boolean, chars int, score double"))
    assert {(r.leader, r.id, r.report_count, r.score) for r in b.collect()} == {(1, 2, 2, 2.7), (3, 3, 1, 1.0)}
    assert b.where(F.col("report_count") > 1).count() == 1


def test_similar_pairs_write_each_set_once(spark):
    """What lies on disk beside the pairs is one copy of the sets, however many blocks there are; grouping makes no pairs at all."""
    rng = random.Random(4)
    held = {i: {f"w{k}" for k in rng.sample(range(70), rng.randint(1, 25))} | {"all"} for i in range(90)}
    sig = spark.createDataFrame([(i, w, 1) for i, ws in held.items() for w in ws], "id long, token string, df long").repartition(5)
    e, nodes = Events(jaccard=0.3, shared=5, overlap=0.7), spark.createDataFrame([(i,) for i in range(93)], "id long")
    was = events.BLOCK, events.HEAD
    events.BLOCK, events.HEAD = 8, 16
    try:
        pairs = events.similar_pairs(sig, e)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Generate" not in plan
        got = {(r.id, r.leader) for r in events.grouped(nodes, sig, e).collect()}
        assert got == {(r.id, r.leader) for r in events.clusters(nodes, pairs, e).collect()}
    finally:
        events.BLOCK, events.HEAD = was
    led = []
    for i in range(93):
        mine = held.get(i, set())
        tells = lambda j: (s := len(mine & held.get(j, set()))) and (s / len(mine | held[j]) >= 0.3 or (s >= 5 and s / min(len(mine), len(held[j])) >= 0.7))  # noqa: B023, E731
        at = next((j for j in led if tells(j)), i)
        led += [i] if at == i else []
        assert (i, at) in got
    assert 10 < len(led) < 90 and len(got) == 93


def test_neighbours_of_equal_vectors_across_blocks(spark, monkeypatch):
    """Ties at the k-th place go to the smaller ids, also where a block holds many of them; less than k anchors give all."""
    monkeypatch.setattr(vectors, "BLOCK", 3)
    monkeypatch.setattr(vectors, "STEP", 8)
    rng = random.Random(3)
    rows = [(i, i % 3, [float(rng.randrange(2)), float(rng.randrange(3)), 1.0]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, label long, v array<double>")
    dots = {(a, b): sum(x * y for x, y in zip(v, w, strict=True)) for a, _, v in rows for b, _, w in rows}
    for k in (1, 5, 60):
        got = {}
        for r in vectors.neighbours(df, df, k).collect():
            got.setdefault(r.id, []).append((-r.sim, r.other))
        assert {a: sorted(x) for a, x in got.items()} == {a: sorted((-dots[a, b], b) for b in range(40) if b != a)[:k] for a in range(40)}
    near = {(r.a, r.b) for r in vectors.near_equal(df, 4.5).collect()}
    assert near == {(a, b) for (a, b), d in dots.items() if a < b and d > 4.5}


def test_pairs_of_blocks_and_least_shared():
    """Every pair of blocks is one tile, tiles of a block follow each other, and only pairs that may reach a limit are looked at one by one."""
    import numpy as np
    from gristmill.operators.overlaps import Index, Sets, ratios

    for blocks in range(1, 10):
        tiles = [events._tile(k, blocks) for k in range(blocks * (blocks + 1) // 2)]
        assert {tuple(sorted(t)) for t in tiles} == {(a, b) for b in range(blocks) for a in range(b + 1)} and len(set(tiles)) == len(tiles)
        assert [a for a, _ in tiles] == sorted(a for a, _ in tiles)
    rng, e = np.random.default_rng(5), Events()
    held = [np.unique(rng.integers(0, 400, n)) for n in rng.integers(1, 120, 300)]
    sets = Sets(np.arange(300), np.array([len(h) for h in held]), np.concatenate(held))
    index, found, looked = Index(sets), set(), 0
    for first, i, j, shared in index.near(sets, lambda a, b: events._least(a, b, e.jaccard, e.overlap, e.shared)):
        looked += len(i)
        assert all(len(np.intersect1d(held[first + x], held[y])) == n for x, y, n in zip(i[:50], j[:50], shared[:50], strict=True))
    for i, j in events._alike(index, sets, e):
        found |= set(zip(i.tolist(), j.tolist(), strict=True))
    want = set()
    for i, a in enumerate(held):
        for j, b in enumerate(held):
            s = len(np.intersect1d(a, b))
            jaccard, overlap = ratios(s, len(a), len(b))
            if s and (jaccard >= e.jaccard or (s >= e.shared and overlap >= e.overlap)):
                want.add((i, j))
    assert found == want and looked < len(held) ** 2 / 3
