"""The main selection: records, cleaned and gated, grouped by event, scored, ordered and cut to the best."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.config import LATIN, Config
from gristmill.functions.cleaning import cleaned
from gristmill.functions.matching import gate, signature_tokens, tokens, verdict
from gristmill.functions.text import is_caption_title
from gristmill.operators import events, ordering, scoring
from gristmill.operators.greedy import cut

#: The test tables are in Latin script, so the step that drops Latin lines is left out on them.
TABLES = Config(words=LATIN)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as records: the first line is the title, the rest the body, the language the lane."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    title = F.substring_index("text", "\n", 1)
    return d.select(F.col("doc_id").alias("id"), title.alias("title"), F.substring("text", F.length(title) + 2, F.lit(2**31 - 1)).alias("body"), F.col("lang").alias("lane"), F.col("source").alias("press"))


def facts(df: DataFrame, config: Config, body: str = "body") -> DataFrame:
    return df.withColumn("facts", gate(F.col("title"), F.col(body), config, {})).withColumn("gate", verdict(F.col("facts"), config.gate))


def selected(df: DataFrame, config: Config, top: int, least_reports: int = 3, without: tuple[str, ...] = ("foreign_lines",)) -> DataFrame:
    """(place, id, report_count, score, score_norm): the best representatives of df (id, title, body).

    Trend keywords look at all records, scores and events at those on topic alone.
    """
    clean = cut(facts(cleaned(df, "body", without=without), config, "body_clean"))
    w = config.words
    weights = cut(scoring.trend_keywords(clean, tokens(F.concat_ws("\n", "title", "body_clean"), w), w, config.trend))
    topical = clean.where("gate = 'ok'")
    scores = scoring.record_scores(topical, tokens(F.col("title"), w), tokens(F.col("body_clean"), w), weights, config.trend)
    sig = cut(events.signature_sets(topical, signature_tokens(F.concat_ws("\n", "title", "body_clean"), w), config.events))
    grouped = events.grouped(topical, sig, config.events) if least_reports <= 0 else events.first_groups(topical, sig, top, least_reports, config.events)
    members = topical.select("id", is_caption_title(F.col("title"), ("포토", "사진")).alias("caption"), F.length("body_clean").alias("chars")).join(grouped, "id").join(scores.select("id", F.round("score", 4).alias("score")), "id", "left").fillna(0.0, ["score"])
    best = events.representatives(members, config.events).withColumn("seq", F.col("leader"))
    placed = ordering.order_by_reports(best, least_reports, "seq").where(F.col("place") <= top)
    most = placed.agg(F.max("score").alias("_top"))
    norm = F.when(F.col("_top") > 0, F.bround(F.col("score") / F.col("_top") * 100)).otherwise(0).cast("long")
    return placed.join(F.broadcast(most)).select("place", "id", "report_count", "score", norm.alias("score_norm")).orderBy("place")
