"""Readers and writers of records: search responses, CSV archives, text corpora, state, metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions.text import canonical_url, first_title, mail_time, strip, strip_tags
from gristmill.operators.sets import first_wins

S, I, D = T.StringType(), T.IntegerType(), T.DoubleType()
RECORD = T.StructType(
    [T.StructField(n, S) for n in ("title", "url", "source", "press", "published", "summary", "search_keyword", "body", "body_clean", "page_id")]
    + [T.StructField("search_rank", I), T.StructField("score_norm", I), T.StructField("report_count", I), T.StructField("keyword_score", D), T.StructField("matched_keywords", T.ArrayType(S)), T.StructField("subtopics", T.ArrayType(S))]
)
DEFAULTS = {"search_rank": 0, "score_norm": 0, "report_count": 1, "keyword_score": 0.0}


def with_defaults(df: DataFrame) -> DataFrame:
    """All fields of a record: missing columns added, unknown ones dropped, nulls replaced by the field's default."""
    out = []
    for f in RECORD:
        c = F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        empty = F.array().cast("array<string>") if isinstance(f.dataType, T.ArrayType) else F.lit(DEFAULTS.get(f.name, ""))
        out.append(F.coalesce(c, empty).alias(f.name))
    return df.select(*out, *[c for c in ("seq", "file") if c in df.columns])


def read_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records of CSV archives: columns by name, sub-topics split at line ends, scores of earlier runs dropped.

    Columns are read as text, as files of different age have different ones; seq orders rows inside a file.
    """
    raw = spark.read.options(header=True, multiLine=True, escape='"', encoding="UTF-8", enforceSchema=False).csv(path)
    names = {c: c.lstrip("﻿") for c in raw.columns}
    df = raw.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("seq"))
    for c in ("keyword_score", "score_norm", "report_count", "matched_keywords"):
        df = df.drop(c)
    if "subtopics" in df.columns:
        df = df.withColumn("subtopics", F.filter(F.split("subtopics", "\n"), lambda x: strip(x) != ""))
    if "search_rank" in df.columns:
        df = df.withColumn("search_rank", F.expr("try_cast(search_rank as int)"))
    return with_defaults(df)


def recent_files(df: DataFrame, since: Column) -> DataFrame:
    """Rows of files whose name carries a time (name_YYYYmmdd_HHMMSS.csv) not before since: Spark prunes by file name."""
    return df.where(F.try_to_timestamp(F.regexp_extract("file", r"(\d{8}_\d{6})", 1), F.lit("yyyyMMdd_HHmmss")) >= since)


def gather(df: DataFrame) -> DataFrame:
    """The first row of each canonical address over files in order of their names."""
    keyed = df.withColumn("_key", canonical_url(F.col("url"))).withColumn("_at", F.struct("file", "seq"))
    return first_wins(keyed.drop("file"), "_key", "_at").drop("_key", "_at")


def write_csv(df: DataFrame, path: str) -> None:
    flat = df.withColumn("subtopics", F.array_join("subtopics", "\n")).withColumn("matched_keywords", F.array_join("matched_keywords", ", "))
    if not flat.isEmpty():
        flat.write.mode("overwrite").options(header=True, escape='"').csv(path)


def search_results(responses: DataFrame, keywords: list[str]) -> DataFrame:
    """Records of search responses (keyword, items array<struct<title,originallink,link,description,pubDate>>).

    An item without an address is skipped, but takes its rank; the original address is preferred.
    """
    order = F.array_position(F.array(*[F.lit(k) for k in keywords]), F.col("keyword"))
    it = responses.select("keyword", order.alias("k"), F.posexplode("items").alias("pos", "i"))
    url = F.coalesce(F.nullif(F.col("i.originallink"), F.lit("")), F.nullif(F.col("i.link"), F.lit("")))
    df = it.select(strip_tags(F.col("i.title")).alias("title"), url.alias("url"), strip_tags(F.col("i.description")).alias("summary"), mail_time(F.col("i.pubDate")).alias("published"), F.col("keyword").alias("search_keyword"), (F.col("pos") + 1).alias("search_rank"), (F.shiftleft(F.col("k").cast("long"), 32) + F.col("pos")).alias("seq"))
    return with_defaults(df.where("url is not null"))


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """(id, title, text) of .md and .txt files below path."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.{md,txt}").text(path, wholetext=True)
    return raw.select(F.regexp_replace("_metadata.file_name", r"\.(md|txt)$", "").alias("id"), first_title(F.col("value")).alias("title"), F.col("value").alias("text"))


STATE = "last_collected_at string, processed_urls array<string>, written_events array<struct<at:string,tokens:string>>, held array<struct<lane:string,held_since:string,article:struct<title:string,url:string,published:string,body:string>>>"


def read_state(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The state as tables; a file that can't be read gives empty ones, and broken entries are left out one by one."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", STATE).alias("s")).where("s is not null")
    events = raw.select(F.explode("s.written_events").alias("e")).where("e is not null and e.at is not null and e.tokens is not null")
    held = raw.select(F.explode("s.held").alias("h")).where("h is not null and h.lane is not null and h.article.url is not null")
    return {
        "watermark": raw.select("s.last_collected_at"),
        "processed": raw.select(F.posexplode("s.processed_urls").alias("seq", "url")).where("url is not null"),
        "events": events.select("e.at", F.array_distinct(F.split("e.tokens", " ")).alias("tokens")),
        "held": held.select("h.lane", "h.held_since", "h.article"),
    }


def append_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)
