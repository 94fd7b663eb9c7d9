"""A store of labels: batches of JSON lines are appended to a log, and compacted into versions of which one pointer names the current."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.text import canonical_url
from gristmill.streaming.incremental import _exists, current_state, write_state

#: The columns of a label; others are left out.
FIELDS = ("url", "title", "label", "labeler", "reason", "labeled_at")
_LABEL = ", ".join(f"{c} string" for c in FIELDS)
_TABLE = f"key string, {_LABEL}, batch long, line long"


def save_labels(labels: DataFrame, folder: str, batch: int) -> None:
    """Append a batch of labels to the log. A repeated batch replaces itself, so it adds nothing twice. Missing columns are empty."""
    rows = labels.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in labels.columns else F.lit("").alias(c) for c in FIELDS))
    rows = rows.withColumn("line", F.monotonically_increasing_id())
    rows.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(f"{folder}/log/batch={batch}")


def _log(spark: SparkSession, folder: str) -> DataFrame:
    """(batch, value) of all lines of the log."""
    if not _exists(spark, f"{folder}/log"):
        return spark.createDataFrame([], "batch long, value string")
    return spark.read.schema("value string, batch long").text(f"{folder}/log").select("batch", "value")


def _current(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    if not _exists(spark, f"{folder}/CURRENT"):
        return spark.createDataFrame([], _TABLE), spark.createDataFrame([], "batch long")
    state = current_state(spark, folder, ("labels", "batches"))
    return state["labels"], state["batches"]


def _merged(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The last label of each address over version and log; the batches that it holds; the lines that can't be read."""
    labels, batches = _current(spark, folder)
    lines = _log(spark, folder).join(batches, "batch", "left_anti")
    read = lines.withColumn("r", F.from_json("value", f"{_LABEL}, line long, _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}))
    good = F.col("r").isNotNull() & F.col("r._broken").isNull() & (F.coalesce(F.col("r.url"), F.lit("")) != "")
    fresh = read.where(good).select(canonical_url(F.col("r.url")).alias("key"), *(F.col(f"r.{c}") for c in FIELDS), "batch", F.coalesce("r.line", F.lit(0).cast("long")).alias("line"))
    last = labels.unionByName(fresh).groupBy("key").agg(F.max_by(F.struct(*FIELDS, "batch", "line"), F.struct("batch", "line")).alias("r")).select("key", "r.*")
    return last, batches.union(lines.select("batch").distinct()).distinct(), read.where(~good).select("batch", "value")


def load_labels(spark: SparkSession, folder: str) -> DataFrame:
    """(key, url, title, label, ...): the last label of each canonical address."""
    return _merged(spark, folder)[0].drop("batch", "line")


def broken_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(batch, value): lines of batches not yet compacted that are no label: they are told apart, and stop nothing."""
    return _merged(spark, folder)[2]


def compact(spark: SparkSession, folder: str) -> str:
    """Write version and log as a new version and point to it, last and in one step. A run that is lost before leaves all as it was."""
    labels, batches, _ = _merged(spark, folder)
    return write_state({"labels": labels, "batches": batches}, folder)


def labelled(labels: DataFrame, domain: list[str], keyword_only: bool = False) -> DataFrame:
    """Labels of the domain; with keyword_only those whose records came by a search (search_keyword not blank)."""
    kept = labels.where(F.col("label").isin(*domain))
    return kept.where(F.trim(F.coalesce("search_keyword", F.lit(""))) != "") if keyword_only else kept
