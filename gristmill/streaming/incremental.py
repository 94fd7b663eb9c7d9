"""Incremental runs: duplicates inside a watermark, a processed history, carry-over with expiry, daily quota."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.operators.sets import append_processed, last_n


def cutoff(last: Column, now: Column, lookback_days: int | None) -> Column:
    """From when on records are looked at: the last run, or further back by the look-back; two days without either."""
    back = now - F.make_dt_interval(F.lit(lookback_days if lookback_days is not None else 2))
    return F.least(F.coalesce(last, back), back) if lookback_days is not None else F.coalesce(last, back)


def since(df: DataFrame, time: str, limit: Column) -> DataFrame:
    """Rows not before limit; an unknown time is kept."""
    return df.where(F.col(time).isNull() | (F.col(time) >= limit))


def moved_on(old: Column, new: Column) -> Column:
    """A watermark never goes back."""
    return F.greatest(old, new)


def first_seen(stream: DataFrame, key: str, time: str, within: str) -> DataFrame:
    """A stream without repeats of key inside the watermark; state is dropped as it moves on."""
    return stream.withWatermark(time, within).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, time: str, within: str, size: str, *keys: str) -> DataFrame:
    """Counts by window and keys of a stream with late rows up to within."""
    return stream.withWatermark(time, within).groupBy(F.window(time, size), *keys).agg(F.count(F.lit(1)).alias("n"))


def history_batch(path: str, key: str, handle: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: rows whose key the history table at path doesn't hold are handled, then their keys are
    added as one file set a batch. A repeated batch replaces its own keys, so it adds nothing twice."""

    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            history = spark.read.parquet(path).where(F.col("epoch") != epoch).select(key) if _exists(spark, path) else None
            fresh = batch.dropDuplicates([key])
            fresh = fresh.join(history, key, "left_anti") if history is not None else fresh
            handle(fresh, epoch)
            fresh.select(key).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
        finally:
            batch.unpersist()

    return run


def _exists(spark, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def live_events(events: DataFrame, at: str, now: Column, keep_days: int) -> DataFrame:
    """History inside its time to live; an unknown time never expires."""
    return since(events, at, now - F.make_dt_interval(F.lit(keep_days)))


def held_status(held: DataFrame, processed: DataFrame, lanes: DataFrame, key: str, published: str, now: Column, days: int) -> DataFrame:
    """held with status: processed, no lane, expired or kept, in that order. Each is counted by grouping on it."""
    h = held.join(processed.select(key).distinct().withColumn("_p", F.lit(True)), key, "left").join(lanes.select("lane").distinct().withColumn("_l", F.lit(True)), "lane", "left")
    old = F.col(published).isNotNull() & (F.col(published) < now - F.make_dt_interval(F.lit(days)))
    return h.withColumn("status", F.when(F.col("_p"), "processed").when(F.col("_l").isNull(), "no lane").when(old, "expired").otherwise("kept")).drop("_p", "_l")


def quota_day(time: Column, zone: str = "America/Los_Angeles") -> Column:
    """The day in whose quota an instant (UTC) falls."""
    return F.to_date(F.from_utc_timestamp(time, zone))


def next_state(state: dict[str, DataFrame], keys: DataFrame, events: DataFrame, until: Column, now: Column, most_keys: int, keep_days: int) -> dict[str, DataFrame]:
    """The state after a run, as tables: processed (seq, key), events (at, tokens), watermark (at).

    New keys (seq, key) follow those known, and the last most_keys stay; events (tokens) get the time now and older ones
    than keep_days go; the watermark never goes back.
    """
    processed = last_n(append_processed(state["processed"], keys.where("key <> ''"), "key", "seq"), "seq", most_keys)
    kept = state["events"].where((F.col("at") >= now - F.make_dt_interval(F.lit(keep_days))) & (F.size("tokens") > 0))
    fresh = events.where(F.size("tokens") > 0).select(now.alias("at"), F.array_sort("tokens").alias("tokens"))
    return {"processed": processed, "events": kept.unionByName(fresh), "watermark": state["watermark"].select(moved_on(F.col("at"), until).alias("at"))}


def write_state(state: dict[str, DataFrame], folder: str) -> str:
    """Write the tables of a state as one version below folder and point CURRENT to it, last and in one step.

    A run that is lost before that leaves the former state as it was. Returns the path of the version.
    """
    spark = next(iter(state.values())).sparkSession
    version = f"{folder.rstrip('/')}/version-{uuid.uuid4().hex}"
    for name, table in state.items():
        table.write.parquet(f"{version}/{name}")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(folder).toUri(), conf)
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.text(f"{version}/_pointer")
    files = path(version).getFileSystem(conf)
    part = next(f.getPath() for f in files.listStatus(path(f"{version}/_pointer")) if f.getPath().getName().startswith("part-"))
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(part, path(f"{folder.rstrip('/')}/CURRENT"), options)
    return version


def current_state(spark: SparkSession, folder: str, names: tuple[str, ...] = ("processed", "events", "watermark")) -> dict[str, DataFrame]:
    """The tables of the version that CURRENT points to."""
    version = spark.read.text(f"{folder.rstrip('/')}/CURRENT").first().value
    return {n: spark.read.parquet(f"{version}/{n}") for n in names}
