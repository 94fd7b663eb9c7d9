"""Numbering, packing and ordering without gathering a table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.operators.greedy import cut


def running(df: DataFrame, keys: list[str], order: list[Column | str], value: Column, into: str) -> DataFrame:
    """df with the running sum of value over the rows of a key up to each row, in order. No keys: over all rows.

    Rows are dealt by range of keys and order, summed inside each part, and moved on by the sums of the key's parts before: no
    key, however many rows it has, is in one task. Rows that order doesn't tell apart come in any order.
    """
    place = [*keys, *order]
    dealt = df.withColumn("_value", value).withColumn("_tie", F.monotonically_increasing_id())
    dealt = cut(dealt.repartitionByRange(*place, "_tie").sortWithinPartitions(*place, "_tie").withColumn("_row", F.monotonically_increasing_id()))
    part = dealt.withColumn("_part", F.shiftright("_row", 33))
    inside = part.withColumn("_sum", F.sum("_value").over(W.partitionBy("_part", *keys).orderBy("_row").rowsBetween(W.unboundedPreceding, W.currentRow)))
    sums = part.groupBy("_part", *keys).agg(F.sum("_value").alias("_all"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_all").over(W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    before = before.select(F.col("_part").alias("_p"), *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "_before")
    on = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return inside.join(before, on).select(*df.columns, (F.col("_sum") + F.col("_before")).alias(into))


def numbered(df: DataFrame, *order: Column | str, into: str = "rn") -> DataFrame:
    """df with 1, 2, 3 ... in order: dealt by range, numbered inside each part, and moved on by the sizes of the parts before.

    The sizes stay a table that is joined by part: nothing of it goes through the driver.
    """
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    dealt = cut(dealt.withColumn("_row", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_row", 33))
    sizes = dealt.groupBy("_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shift = sizes.select("_part", (before - F.col("_first") + 1).alias("_shift"))
    return dealt.join(shift, "_part").withColumn(into, (F.col("_row") + F.col("_shift")).cast("long")).drop("_part", "_row", "_shift")


def round_robin(df: DataFrame, keyword: str, rank: str, seq: str, order: list[str]) -> DataFrame:
    """df with place, from 1: the k-th of each keyword's queue in turn, keywords in the given order, then others by first
    appearance; rows without keyword or rank come last, as they came."""
    has = F.col(keyword).isNotNull() & (F.col(keyword) != "") & F.coalesce(F.col(rank) != 0, F.lit(False))
    known = F.array_position(F.array(*[F.lit(k) for k in order]).cast("array<string>"), F.col(keyword))
    q = df.withColumn("_has", has)
    w = W.partitionBy("_has", keyword)
    q = q.withColumn("_turn", F.when(F.col("_has"), F.row_number().over(w.orderBy(rank, seq))).otherwise(0))
    q = q.withColumn("_known", F.when(~F.col("_has"), 0).when(known > 0, known).otherwise(len(order) + 1)).withColumn("_first", F.when(F.col("_has"), F.min(seq).over(w)).otherwise(0))
    return numbered(q, ~F.col("_has"), "_turn", "_known", "_first", seq, into="place").drop("_has", "_turn", "_known", "_first")


def packs(df: DataFrame, seq: str, size: int = 4) -> DataFrame:
    """df with pack, from 0, and full: whether the pack has size rows."""
    n = numbered(df, seq).withColumn("pack", F.floor((F.col("rn") - 1) / size))
    return n.withColumn("full", F.count(F.lit(1)).over(W.partitionBy("pack")) == size).drop("rn")


def order_by_reports(df: DataFrame, least: int, seq: str) -> DataFrame:
    """Three orders: least <= 0 by falling report_count; 1 as it came; else those with least reports first."""
    first = -F.col("report_count") if least <= 0 else (F.col("report_count") < least).cast("int")
    return numbered(df, first, seq, into="place")


def lowest_quarter(df: DataFrame, value: str, seq: str) -> DataFrame:
    """df with low: value not above the one at place max(n // 4 - 1, 0) in rising order."""
    n = numbered(df, value, seq).withColumn("_n", F.lit(df.count()))
    limit = n.where(F.col("rn") == F.greatest(F.floor(F.col("_n") / 4) - 1, F.lit(0)) + 1).select(F.col(value).alias("_limit"))
    return n.join(F.broadcast(limit)).withColumn("low", F.col(value) <= F.col("_limit")).drop("_n", "_limit", "rn")
