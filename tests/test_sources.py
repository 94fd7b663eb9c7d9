"""Readers, writers and incremental runs."""

import json

from pyspark.sql import functions as F

from gristmill.sources import records
from gristmill.streaming import incremental


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("T, \"q\"", "https://a.example/x?utm_source=f", ["a", "b"], 3), ("U", "https://a.example/x", [], None)], "title string, url string, subtopics array<string>, search_rank int")
    records.write_csv(records.with_defaults(df), f"{tmp_path}/out")
    back = records.read_csv(spark, f"{tmp_path}/out")
    rows = sorted(back.collect(), key=lambda r: r.title)
    assert [(r.title, r.subtopics, r.search_rank, r.report_count, r.keyword_score) for r in rows] == [('T, "q"', ["a", "b"], 3, 1, 0.0), ("U", [], 0, 1, 0.0)]
    assert records.gather(back).count() == 1


def test_search_results(spark):
    item = "struct<title:string,originallink:string,link:string,description:string,pubDate:string>"
    rows = [("k2", [("<b>A</b>", "", "https://l.example/1", "d", "x"), ("B", "", "", "d", "x"), ("C", "https://o.example/3", "https://l.example/3", "d", "x")]), ("k1", [("D", None, "https://l.example/4", None, None)])]
    got = records.search_results(spark.createDataFrame(rows, f"keyword string, items array<{item}>"), ["k1", "k2"]).orderBy("seq").collect()
    assert [(r.title, r.url, r.search_rank) for r in got] == [("D", "https://l.example/4", 1), ("A", "https://l.example/1", 1), ("C", "https://o.example/3", 3)]


def test_state(spark, tmp_path):
    at = tmp_path / "state.json"
    at.write_text(json.dumps({"last_collected_at": "2026-01-01T00:00:00+09:00", "processed_urls": ["u1", None, "u2"], "written_events": [{"at": "2026-01-01", "tokens": "a b a"}, {"at": None, "tokens": "c"}], "held": [{"lane": "x", "held_since": "2026-01-01", "article": {"url": "u3"}}, {"lane": None}]}))
    state = records.read_state(spark, str(at))
    assert [r.url for r in state["processed"].orderBy("seq").collect()] == ["u1", "u2"]
    assert [r.tokens for r in state["events"].collect()] == [["a", "b"]] and state["held"].count() == 1
    at.write_text("not json")
    assert records.read_state(spark, str(at))["processed"].count() == 0


def test_corpus(spark, tmp_path):
    (tmp_path / "a.md").write_text("\n# Title\ntext")
    (tmp_path / "b.txt").write_text("first\nsecond")
    (tmp_path / "c.csv").write_text("no")
    assert {(r.id, r.title) for r in records.read_corpus(spark, str(tmp_path)).collect()} == {("a", "Title"), ("b", "first")}


def test_history_of_batches(spark, tmp_path):
    handled = []
    run = incremental.history_batch(f"{tmp_path}/keys", "key", lambda df, epoch: handled.append((epoch, sorted(r.key for r in df.collect()))))
    batch = lambda *keys: spark.createDataFrame([(k,) for k in keys], "key string")
    run(batch("a", "b", "a"), 0)
    run(batch("b", "c"), 1)
    run(batch("b", "c"), 1)  # a repeated batch does the same again
    assert handled == [(0, ["a", "b"]), (1, ["c"]), (1, ["c"])]


def test_cutoff(spark):
    ts = lambda x: F.lit(x).cast("timestamp")
    row = spark.range(1).select(incremental.cutoff(ts("2026-01-09"), ts("2026-01-10"), 3).cast("string").alias("back"), incremental.cutoff(ts(None), ts("2026-01-10"), None).cast("string").alias("two"), incremental.moved_on(ts("2026-01-09"), ts("2026-01-08")).cast("string").alias("top")).first()
    assert tuple(row) == ("2026-01-07 00:00:00", "2026-01-08 00:00:00", "2026-01-09 00:00:00")


def test_many_results_keep_their_order(spark):
    item = "struct<title:string,originallink:string,link:string,description:string,pubDate:string>"
    rows = [("k1", [(f"a{i}", None, f"https://l.example/{i}", None, None) for i in range(1203)]), ("k2", [("b", None, "https://l.example/b", None, None)])]
    got = records.search_results(spark.createDataFrame(rows, f"keyword string, items array<{item}>"), ["k1", "k2"]).orderBy("seq").collect()
    assert [r.title for r in got] == [*(f"a{i}" for i in range(1203)), "b"]
