"""Scalars and cleaning rules on hand-made cases, also in the script that the rules are written for."""

import pytest
from pyspark.sql import functions as F

from gristmill.config import Config
from gristmill.functions import cleaning, matching, structure, text


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "x string").select(make(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("url", "want"),
    [
        (" HTTP://Www.A.example/X/ ", "http://www.a.example/X"),
        ("https://a.example", "https://a.example/"),
        ("https://a.example/p?UTM_Source=z&id=1&b=#t", "https://a.example/p?id=1&b="),
        ("not a url", "not a url"),
        ("", ""),
        (None, None),
    ],
)
def test_canonical_url(spark, url, want):
    assert one(spark, url, text.canonical_url) == want


def test_title_key_and_slug(spark):
    assert one(spark, "A - B - Press", text.title_key) == "AB"
    assert one(spark, "…!", text.title_key) == "" and one(spark, "!!", text.slug) == "draft"
    assert one(spark, "[포토] 국기원 시범", lambda c: text.is_caption_title(c, ("포토", "사진")))
    assert one(spark, "Fri, 27 Nov 2026 03:08:02 +0000", text.mail_time) == "2026-11-27T12:08:02+09:00" and one(spark, "gestern", text.mail_time) == "gestern"
    assert one(spark, "<b>A &amp;lt; B</b> ", text.strip_tags) == "A &lt; B"


def test_cleaning_in_hangul(spark):
    long = "태권도 대회가 서울에서 열렸다. " * 8
    body = f"| 사진 설명 |\n(서울=연합뉴스) 홍길동 기자 = {long}\n홍길동 기자 hong@a.example\n무단 전재 및 재배포 금지\n선수들이 겨루는 모습.\n관련기사\n다른 소식\n- 하나"
    df = cleaning.cleaned(spark.createDataFrame([(body,), (None,), ("",)], "body string"), "body", diagnose=True)
    rows = df.collect()
    assert rows[0].body_clean == long.strip()
    assert {"caption_lines", "agency_lines", "boilerplate_lines", "plain_captions", "cut_at_section"} <= set(rows[0].lost)
    assert rows[1].body_clean == rows[2].body_clean == ""
    assert cleaning.kept_records(df).count() == 1


def test_cleaning_rules(spark):
    piped = "| a |\n|" + "b" * 90 + "|\ncc"
    assert one(spark, piped, cleaning.caption_lines) == piped  # too much would go
    assert one(spark, "관련기사\n짧다", cleaning.cut_at_section) == "짧다"
    assert one(spark, "a" * 39, cleaning.foreign_lines) == "a" * 39 and one(spark, "a" * 40, cleaning.foreign_lines) == ""
    assert one(spark, "본문\n(끝)\n나머지", cleaning.cut_at_terminator) == "본문"
    assert one(spark, "- a\n\nb\n- c\nd\n※ e", cleaning.edge_lists) == "b\n- c\nd"
    assert one(spark, "# T\n**b** [l](u) `c`\n- i", cleaning.strip_markdown) == "T\nb l c\ni"
    assert one(spark, "가나 abc https://x.example/abcdef", cleaning.home_share) == 0.4


def test_tokens_and_gate(spark):
    w = Config().words
    assert one(spark, "국기원에서 태권도를 했다", lambda c: matching.tokens(c, w)) == ["국기원", "태권도"]
    assert one(spark, "태권도장 태권도", lambda c: matching.spans_in(c, ("태권도", "도장", "태권"))) == 2
    df = spark.createDataFrame([("태권도 대회", "태권도 " * 200), ("태권도 사범 성추행 혐의", "태권도 " * 200), ("날씨", "맑음 " * 200), ("태권도", "짧다"), (None, None)], "title string, body string")
    gates = [r.g for r in df.select(matching.verdict(matching.gate(F.col("title"), F.col("body"), Config(), {}), Config().gate).alias("g")).collect()]
    assert gates[1:4] == ["incident", "core", "body"]


def test_structure(spark):
    assert one(spark, "ab\n 1 \n\n12\n123", structure.image_slots) == 2
    assert one(spark, " ab \n\n c", structure.prose_chars) == 3
    assert one(spark, "aa\n\nbbb\n\ncccc", lambda c: structure.within_length(c, 5)) == "aa\n\nbbb" and one(spark, "abcdef", lambda c: structure.within_length(c, 5)) == "abcde"
    assert one(spark, "왜 태권도인가, 지금?", structure.title_issues) == ["length", "characters"]


def test_strip_takes_white_space_of_any_script(spark):
    from gristmill.functions.text import strip

    white = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in "\x1c\x1d\x1e\x1f"]
    rows = [(f"{a}{b}x {a}y{b}{a}",) for a in white for b in white[:4]] + [("",), (" ",), (None,), ("​z​",)]
    for r in spark.createDataFrame(rows, "t string").select("t", strip(F.col("t")).alias("s")).collect():
        assert r.s == (None if r.t is None else r.t.strip())


def test_kept_records_compute_a_body_once(spark):
    mail, site = "가.나-b@c.example.-다@e.fr", "www.가나.example https://b.example/가"
    rows = [(1, "가" * 60 + "a" * 60), (2, "가" * 60 + "a" * 61), (3, None), (4, "가" * 99), (5, f"{'가a ' * 50}{mail}"), (6, f"{'가a' * 50} {site}"), (7, "." * 200), (8, f"{'가a ' * 50}b@c")]
    df = spark.createDataFrame(rows, "id long, body string").withColumn("body_clean", F.translate("body", "z", "y"))
    kept = cleaning.kept_records(df)
    assert sorted(r.id for r in kept.collect()) == [1, 5, 6]
    assert kept._jdf.queryExecution().optimizedPlan().toString().split("Filter")[1].split("\n")[0].count("translate(") == 1
    got = {r.id: r.s for r in df.select("id", cleaning.home_share(F.col("body")).alias("s")).collect()}
    assert got == {1: 0.5, 2: 60 / 121, 3: 0.0, 4: 1.0, 5: 0.5, 6: 0.5, 7: 0.0, 8: 50 / 102}
