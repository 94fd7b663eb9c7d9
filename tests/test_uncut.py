"""Class, lane and policy tables of any length: nothing beyond the first thousand rows is lost."""

import math

from pyspark.sql import functions as F

from gristmill.operators import sets, vectors
from gristmill.plans import queries
from gristmill.streaming import incremental

N = 1200


def circle(spark):
    """Two equal vectors a label, each label in a direction of its own."""
    rows = [(2 * k + twin, k, [math.cos(2 * math.pi * k / N), math.sin(2 * math.pi * k / N)]) for k in range(N) for twin in (0, 1)]
    return spark.createDataFrame(rows, "id long, label long, v array<double>")


def test_every_class_can_be_predicted(spark):
    df = circle(spark)
    for leave_out in (False, True):
        got = vectors.centroid_predict(df, leave_out).select("id", "label", "margin").collect()
        assert {(r.id, r.label) for r in got} == {(2 * k + twin, k) for k in range(N) for twin in (0, 1)}
        assert all(abs(r.margin - (1 - math.cos(2 * math.pi / N))) < 1e-9 for r in got)


def test_every_class_is_a_probe(spark, tmp_path):
    circle(spark).where("id % 2 = 0").select(F.col("id").alias("vec_id"), F.col("label").cast("int").alias("label"), F.col("v").alias("embedding")).write.parquet(f"{tmp_path}/embeddings.parquet")
    best = queries._probes(spark, str(tmp_path)).groupBy("q").agg(F.max_by("i", "sim").alias("i"), F.count(F.lit(1)).alias("n")).collect()
    assert {(r.q, r.i, r.n) for r in best} == {(k, 2 * k, N) for k in range(N)}


def test_lanes_and_policies_are_whole(spark):
    now = F.expr("timestamp_ntz'2024-01-31 00:00:00'")
    rows = spark.range(N).select(F.col("id").alias("seq"), F.concat(F.lit("l"), "id").alias("lane"), F.col("id").alias("key"), F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("ts"))
    lanes = rows.select("lane", F.lit(3).alias("lookback_days"))
    verdicts = spark.createDataFrame([], "key long, verdict string")
    assert sets.route(rows, verdicts, "key", "seq", "org", lanes, "ts", now).count() == N
    policy = rows.select(F.col("lane").alias("status"), F.lit(3).alias("days"))
    assert sets.retained(rows.withColumnRenamed("lane", "status"), policy, "ts", now).count() == 0
    held = incremental.held_status(rows, rows.where("false"), lanes, "key", "ts", now, 7)
    assert {(r.status, r["count"]) for r in held.groupBy("status").count().collect()} == {("expired", N)}


def test_route_thins_rows_before_the_join(spark):
    day = lambda d: f"2024-01-{d:02d}"
    made = [(i, "abc"[i % 3], i % 5 if i % 11 else None, day(i * 7 % 30 + 1) if i % 4 else None) for i in range(240)]
    rows = spark.createDataFrame(made, "seq long, lane string, key long, day string").withColumn("ts", F.to_timestamp_ntz("day")).drop("day")
    lanes, windows = spark.createDataFrame([("a", 9), ("b", 2), ("c", 20)], "lane string, lookback_days int"), {"a": 9, "b": 2, "c": 20}
    said = {0: "a", 1: "b", 2: "c", 3: "none"}
    want = {}
    for seq, lane, key, at in made:
        to = "a" if said.get(key) == "a" else said.get(key) if lane == "a" else lane
        if to in windows and (to == lane or at is None or at >= day(31 - windows[to])):
            want.setdefault((to, key), (seq, lane, at))
    got = sets.route(rows, spark.createDataFrame(list(said.items()), "key long, verdict string"), "key", "seq", "a", lanes, "ts", F.expr("timestamp_ntz'2024-01-31 00:00:00'"))
    assert {(r.lane, r.key): (r.seq, r.moved_from, r.ts and f"{r.ts:%Y-%m-%d}") for r in got.collect()} == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter") < plan.index("min(seq")  # what is joined by key is one row for each key, lane and windows
