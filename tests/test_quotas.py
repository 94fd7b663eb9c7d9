"""Accepting scans against the plain loop that defines them."""

import random

import pytest
from pyspark.sql import functions as F

from gristmill.operators import ordering, quotas
from gristmill.operators.quotas import Quota


def loop(rows, limits):
    """rows: (seq, keys, reason) in order; limits: (name, most, taken, stops, first, read)."""
    used = [dict(taken) for _, _, taken, *_ in limits]
    out = {}
    for seq, keys, reason in rows:
        full = [k is not None and used[j].get(k, 0) >= limits[j][1] for j, k in enumerate(keys)]
        names = lambda test: [lim[0] for lim, f in zip(limits, full, strict=True) if f and test(lim)]
        early = names(lambda x: x[3]) + names(lambda x: x[4] and not x[3])
        why = (early + ([reason] if reason else []) + names(lambda x: not x[3] and not x[4]))[:1]
        # a row with a reason is read all the same, if nothing before it stops it
        read = not any(full) if reason is None else not early
        for j, k in enumerate(keys):
            if k is not None and ((reason is None and not any(full)) or (reason and read and limits[j][5] and not full[j])):
                used[j][k] = used[j].get(k, 0) + 1
        out[seq] = why[0] if why else "accepted"
    return out


@pytest.mark.parametrize("case", range(6))
def test_against_a_loop(spark, case, monkeypatch):
    monkeypatch.setattr(quotas, "HEAD", [1, 7, 20_000][case % 3])
    rng = random.Random(case)
    names, sets, queries, n = rng.choice([3, 40]), rng.choice([2, 9]), rng.choice([2, 5]), [12, 60, 400][case % 3]
    read = case % 2 == 1
    rows = []
    for i in range(n):
        query = f"q{i * queries // n}"
        rows.append((i, rng.choice([None, *(f"n{k}" for k in range(names))]), rng.choice(["hot", "hot", *(f"s{k}" for k in range(sets))]), query, f"c{i * 2 // n}", rng.choice([None, None, "small"])))
    prior = {"hot": rng.randrange(3), "s0": 2}
    limits = [("target", 12, {}, True, False, False), ("quota", 5, {}, True, False, False), ("duplicate", 1, {"n0": 1}, False, True, read), ("set", 4, prior, False, False, False)]
    want = loop([(i, (c, q, name, s), reason) for i, name, s, q, c, reason in rows], limits)
    df = spark.createDataFrame(rows, "i long, name string, s string, q string, c string, reason string").repartition(3)
    taken = lambda d: spark.createDataFrame(list(d.items()), "key string, n long")
    asked = [Quota("target", "c", 12, stops=True), Quota("quota", "q", 5, stops=True), Quota("duplicate", "name", 1, taken({"n0": 1}), first=True, read=read), Quota("set", "s", 4, taken(prior))]
    got = quotas.scanned(df, ["i"], asked, F.col("reason"))
    assert got.columns == [*df.columns, "verdict"]
    assert {r.i: r.verdict for r in got.collect()} == want


def test_large_quota_limits_by_column_and_no_rows(spark, monkeypatch):
    rows = [(i, "all", f"n{i % 700}", 300) for i in range(1500)]
    df = spark.createDataFrame(rows, "i long, c string, name string, most int")
    want = loop([(i, (c, name), None) for i, c, name, _ in rows], [("target", 300, {}, True, False, False), ("duplicate", 1, {}, False, True, False)])
    asked = [Quota("target", "c", "most", stops=True), Quota("duplicate", "name", 1, first=True)]
    assert {r.i: r.verdict for r in quotas.scanned(df, ["i"], asked).collect()} == want
    monkeypatch.setattr(quotas, "LIMITED", 10)
    monkeypatch.setattr(quotas, "HEAD", 500)
    assert {r.i: r.verdict for r in quotas.scanned(df, ["i"], asked).collect()} == want
    assert quotas.scanned(df.limit(0), ["i"], asked).count() == 0
    unmet = quotas.scanned(df, ["i"], [Quota("target", "c", 5000, stops=True)])
    assert unmet.where("verdict = 'accepted'").count() == 1500
    assert quotas.scanned(df, ["i"], [Quota("target", "c", 0, stops=True)]).where("verdict = 'target'").count() == 1500


def test_running_sums(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 8 + ["a", None]), i, rng.randrange(5)) for i in range(400)]
    got = ordering.running(spark.createDataFrame(rows, "k string, i int, v int").repartition(4), ["k"], ["i"], F.col("v"), "s").collect()
    total = {}
    want = set()
    for k, i, v in rows:
        total[k] = total.get(k, 0) + v
        want.add((k, i, v, total[k]))
    assert {tuple(r) for r in got} == want
    same = ordering.numbered(spark.createDataFrame([(1,)] * 50, "x int").repartition(3), "x")
    assert sorted(r.rn for r in same.collect()) == list(range(1, 51))


def test_scans_carry_no_texts(spark, monkeypatch):
    """What a scan numbers and writes between its rounds are keys, not the texts of the table."""
    from gristmill.plans import scans

    seen, real = [], quotas.scanned
    monkeypatch.setattr(quotas, "scanned", lambda df, *a: seen.append(df.columns) or real(df, *a))
    scans.quota_scan(spark, "/root/testdata/sf0.001")
    assert seen and "text" not in seen[0]


def test_rows_behind_a_full_key_cost_no_rounds(spark, monkeypatch):
    """Forty queries of many rows each, of which a few are taken: all are decided in a few rounds, not in as many as their rows fill heads."""
    monkeypatch.setattr(quotas, "HEAD", 300)
    monkeypatch.setattr(quotas, "_few", lambda most: 4 * most)
    rng, rows = random.Random(8), []
    for i in range(8000):
        rows.append((i, f"q{i // 200}", f"c{i // 1000}", f"n{rng.randrange(90)}", rng.choice([None, None, None, "small"])))
    limits = [("target", 9, {}, True, False, False), ("quota", 3, {}, True, False, False), ("duplicate", 1, {}, False, True, True)]
    want = loop([(i, (c, q, name), reason) for i, q, c, name, reason in rows], limits)
    seen, real = [], quotas._head
    monkeypatch.setattr(quotas, "_head", lambda *a: seen.append(1) or real(*a))
    df = spark.createDataFrame(rows, "i long, q string, c string, name string, reason string").repartition(3)
    asked = [Quota("target", "c", 9, stops=True), Quota("quota", "q", 3, stops=True), Quota("duplicate", "name", 1, first=True, read=True)]
    assert {r.i: r.verdict for r in quotas.scanned(df, ["i"], asked, F.col("reason")).collect()} == want
    assert len(seen) < 10
