"""State as versions with one pointer, and drafts with block marks."""

import datetime as dt

from pyspark.sql import functions as F

from gristmill.functions import drafts
from gristmill.streaming import incremental


def test_state_is_replaced_in_one_step(spark, tmp_path):
    day = lambda n: dt.datetime(2024, 1, n)
    state = {
        "processed": spark.createDataFrame([(i, f"k{i}") for i in range(4)], "seq long, key string"),
        "events": spark.createDataFrame([(day(1), ["old"]), (day(20), ["b", "a"]), (day(21), [])], "at timestamp_ntz, tokens array<string>"),
        "watermark": spark.createDataFrame([(day(22),)], "at timestamp_ntz"),
    }
    now = F.expr("timestamp_ntz'2024-01-31 00:00:00'")
    fresh = spark.createDataFrame([(0, "k1"), (1, "new"), (2, "new"), (3, "")], "seq long, key string")
    told = spark.createDataFrame([(["z", "y"],), ([],)], "tokens array<string>")
    step = lambda s: incremental.next_state(s, fresh, told, F.expr("timestamp_ntz'2024-01-25 00:00:00'"), now, 4, 14)
    after = step(state)
    first = incremental.write_state(after, str(tmp_path / "state"))
    read = incremental.current_state(spark, str(tmp_path / "state"))
    assert [r.key for r in read["processed"].orderBy("seq").collect()] == ["k2", "k3", "new", "new"]
    assert sorted((r.at, r.tokens) for r in read["events"].collect()) == [(day(20), ["b", "a"]), (day(31), ["y", "z"])]
    assert read["watermark"].first().at == day(25)
    second = incremental.write_state({**read, "watermark": state["watermark"]}, str(tmp_path / "state"))
    assert first != second
    assert incremental.current_state(spark, str(tmp_path / "state"))["watermark"].first().at == day(22)


def test_drafts(spark):
    text = "## 첫 번째는 제목\n1. 두 번째는 좋은 이야기\n- *기울임* 과 **굵게**\n/*  소제목 */ 그대로\n3\n2 * 3 * 4\n안녕히"
    p = spark.createDataFrame([(text,)], "t string").select(drafts.postprocessed(F.col("t"), [("좋은", "멋진")], "안녕히").alias("p")).first().p
    assert p.text == "첫 번째는 제목\n두 번째는 멋진 이야기\n기울임 과 굵게\n/*  소제목 */ 그대로\n3\n2  3  4\n안녕히"
    assert (p.residue, p.chapters, p.style) == (5, 1, 1)
    df = spark.createDataFrame([("a /* 본문 */ \nb\u200b  \n끝\n", "C:\\x\\y/Some Set_012"), (None, None)], "t string, n string")
    rows = df.select(drafts.measured(F.col("t"), "끝").alias("m"), drafts.base_name(F.col("n")).alias("b"), drafts.set_name(drafts.base_name(F.col("n"))).alias("s")).collect()
    assert tuple(rows[0]) == ("a\nb", "Some Set_012", "some set") and rows[1].m is None


def test_credits_by_provenance(spark):
    from gristmill.functions.media import GENERATED
    from gristmill.operators import board

    rows = [("generated", "x/a.jpg"), ("stock", None), ("stock", ""), ("stock", "C:\\x\\a.jpg"), ("stock", "b.jpg"), ("stock", "c.jpg"), ("stock", "d.jpg"), ("stock", "pexels-1.jpg"), ("stock", "unknown.jpg"), (None, "e.jpg")]
    known = [("a.jpg", "lens", None), ("b.jpg", "commons", "MUSEUM"), ("c.jpg", "commons", None), ("d.jpg", "drawn", None), ("e.jpg", "odd", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, source string, original string")
    made = board.with_credits(df, spark.createDataFrame(known, "name string, source string, provider string"), [("^pexels", "Pexels")], {"lens": "Lens"}, {"commons": {"museum": "The Museum", "": "Commons"}}, ("generated", "drawn"))
    assert made.columns == [*df.columns, "credit"]
    assert [r.credit for r in made.orderBy("i").collect()] == [GENERATED, "", "", "Lens", "The Museum", "Commons", GENERATED, "Pexels", "", ""]


def test_options_are_merged_and_renamed(spark):
    from gristmill.operators import board

    of = lambda rows, kind: spark.createDataFrame(rows, kind)
    have, wanted = of([("b", 2), ("a", 1), ("c", 3)], "name string, pos int"), of([("c", 1), ("new", 2), ("z", 0)], "name string, pos int")
    renames = of([(1, "a", "c"), (2, "b", "new"), (3, "c", "new"), (4, "gone", "y")], "pos int, old string, new string")
    assert [tuple(r) for r in board.merged_options(have, wanted, renames).orderBy("pos").collect()] == [(0, "a", None), (1, "new", "b"), (2, "c", None), (3, "z", "+")]
