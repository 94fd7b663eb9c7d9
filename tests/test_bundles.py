"""Bundles of the query: what is shuffled and written follows the records, and packs are those of a loop."""

import os
import random

from pyspark.sql import functions as F

from gristmill.operators import events
from gristmill.plans import queries


def _stages(spark):
    sc, gateway = spark.sparkContext._jsc.sc(), spark.sparkContext._gateway
    sc.listenerBus().waitUntilEmpty()
    found = sc.statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return {(s.stageId(), s.attemptId()): s for s in (found.apply(i) for i in range(found.size()))}


def _word(*numbers):
    return "z".join("".join(chr(97 + int(d)) for d in f"{n:03}") for n in numbers)


def _packs(topics):
    """topics: lists of ids. Packs of four inside a topic, then of what is left in order."""
    out, rest = {}, []
    for ids in map(sorted, topics):
        full = len(ids) // 4 * 4
        out |= {i: (ids[k // 4 * 4], "topic") for k, i in enumerate(ids[:full])}
        rest += ids[full:]
    rest.sort()
    for k, i in enumerate(rest):
        out[i] = (rest[k // 4 * 4], "daily" if k // 4 * 4 + 4 <= len(rest) else "held")
    return out


def test_bundles_shuffle_no_rows_of_words(spark, tmp_path):
    rng, rows, topics = random.Random(4), [], [[] for _ in range(7)]
    for i in range(600):
        t = rng.randrange(7) if rng.random() < 0.05 else 0  # one topic holds most records, as in the tables
        topics[t].append(i)
        rows.append((i, "\n" + " ".join([_word(t, t), _word(t, t, t)] + [_word(i, k) for k in range(10, 160)]), "en", "s"))
    rows += [(600, "\nalone", "en", "s"), (601, "", "en", "s"), (602, None, "en", "s")]
    path = os.fspath(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3).write.parquet(f"{path}/documents.parquet")
    before = set(_stages(spark))
    got = {r.id: (r.bundle, r.kind) for r in queries.bundles(spark, path).collect()}
    moved = sum(s.shuffleWriteBytes() for k, s in _stages(spark).items() if k not in before)
    assert got == _packs([*topics, [600], [601], [602]])
    # 90,000 distinct words of 600 records: a row for each is some 0.7 MB of hashes alone, every time it is shuffled
    assert moved < 2_000_000, moved


def test_bundles_write_words_once(spark, tmp_path):
    rng, rows = random.Random(6), []
    for i in range(600):
        rows.append((i, "\n" + " ".join(["sharedone sharedtwo"] + [_word(i, k) for k in rng.sample(range(10, 400), 150)]), "en", "s"))
    rows.append((600, "\nalone", "en", "s"))
    path = os.fspath(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3).write.parquet(f"{path}/documents.parquet")
    before = set(_stages(spark))
    got = {r.id: (r.bundle, r.kind) for r in queries.bundles(spark, path).collect()}
    written = sum(s.outputBytes() for k, s in _stages(spark).items() if k not in before)
    assert got == _packs([list(range(600)), [600]])
    # 90,000 hashes that are all different are 0.72 MB; twice that, if records that have a label keep their words
    assert written < 1_100_000, written


def test_hashes_in_files_follow_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(events, "shared_folder", lambda _, name: f"{os.fspath(tmp_path)}/{name}")
    sizes = []
    for n in (20_000, 100_000):
        words = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda k: F.xxhash64(F.pmod(F.xxhash64("id", k), F.lit(150_000))))
        saved = events._saved(spark.range(0, n, 1, 1).select("id", words.alias("words")), f"words-{n}")
        assert saved.select(F.sum(F.size("words"))).first()[0] == 20 * n
        sizes.append(sum(f.stat().st_size for f in (tmp_path / f"words-{n}").glob("*.parquet")))
    # 150,000 different hashes don't fit into a dictionary of 1 MB; then a place that is 18 bits costs 64
    assert sizes[1] < 20 * 100_000 * 4, sizes
    assert sizes[1] < 5 * sizes[0], sizes


def test_one_large_topic_is_not_one_task(spark, monkeypatch):
    monkeypatch.setattr(events, "STRETCH", 64, raising=False)
    ids = spark.range(0, 8000, 1, 4)
    topic = ids.where("id >= 10").select("id", F.when(F.col("id") % 1000 == 999, F.lit(999)).otherwise(10).alias("root"))
    sizes = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in sizes}
    before = set(_stages(spark))
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        got = {r.id: (r.bundle, r.kind) for r in events.bundles(ids, topic).collect()}
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    large, small = [i for i in range(10, 8000) if i % 1000 != 999], list(range(999, 8000, 1000))
    assert got == _packs([[i] for i in range(10)] + [large, small])
    most = 0
    for k, s in _stages(spark).items():
        if k not in before and s.shuffleReadRecords() > 8000:
            tasks = spark.sparkContext._jsc.sc().statusStore().taskList(*k, 10_000)
            read = sorted(tasks.apply(i).taskMetrics().get().shuffleReadMetrics().recordsRead() for i in range(tasks.size()))
            most = max(most, read[-1])
    assert 0 < most < 4000, most
