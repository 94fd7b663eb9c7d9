"""Evaluation: precision and recall, sweeps in one pass, confusion, agreement, crosstabs."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.config import Gate
from gristmill.functions.matching import verdict


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def precision_recall(df: DataFrame, truth: Column, predicted: Column, by: list[str] | None = None) -> DataFrame:
    """tp, fp, fn, tn, precision, recall, f1; 0 where nothing can be divided."""
    t, p = F.coalesce(truth, F.lit(False)), F.coalesce(predicted, F.lit(False))
    g = df.groupBy(*(by or [])).agg(F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"), F.count_if(~t & ~p).alias("tn"))
    g = g.withColumn("precision", _ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", _ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    return g.withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def grid(spark, **values: list) -> DataFrame:
    """All combinations of limits, one row each: as long as the caller's lists, so it can be sent to all tasks."""
    names = list(values)
    return spark.createDataFrame([tuple(float(x) for x in row) for row in product(*values.values())], ", ".join(f"{n} double" for n in names))


def gate_sweep(facts: DataFrame, truth: Column, combinations: DataFrame) -> DataFrame:
    """precision_recall for each combination of gate limits: facts are computed once, then judged by every combination."""
    names = combinations.columns
    judged = facts.join(F.broadcast(combinations)).withColumn("_ok", verdict(F.col("facts"), {n: F.col(n) for n in names if hasattr(Gate(), n)}) == "ok")
    return precision_recall(judged, truth, F.col("_ok"), names)


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(truth, predicted).agg(F.count(F.lit(1)).alias("n"))


def adoption(df: DataFrame, truth: str, predicted: str, margin: str, seq: str, shares: tuple[float, ...] = (0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """(share, n, accuracy) of the rows with the largest margins. Places come from counts of margins, not from a global sort."""
    from gristmill.operators.ordering import numbered

    r = numbered(df, F.desc(margin), seq)
    total = df.count()
    parts = [r.where(F.col("rn") <= round(total * s)).agg(F.lit(s).alias("share"), F.count(F.lit(1)).alias("n"), F.avg((F.col(truth) == F.col(predicted)).cast("double")).alias("accuracy")) for s in shares]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def crosstab(df: DataFrame, row: str, column: str) -> DataFrame:
    """(row, column, n, share): counts with both totals ('all') and each cell's share of its column."""
    g = df.cube(row, column).agg(F.count(F.lit(1)).alias("n"), F.grouping(row).alias("gr"), F.grouping(column).alias("gc"))
    g = g.select(F.when(F.col("gr") == 1, "all").otherwise(F.col(row)).alias(row), F.when(F.col("gc") == 1, "all").otherwise(F.col(column)).alias(column), "n")
    return g.withColumn("share", F.col("n") / F.max("n").over(W.partitionBy(column)))


def coverage(df: DataFrame, probes: DataFrame, best: str) -> DataFrame:
    """(probe, n): how many rows each probe is best for, probes without any too."""
    return probes.join(df.groupBy(F.col(best).alias("probe")).agg(F.count(F.lit(1)).alias("n")), "probe", "left").select("probe", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def spread(df: DataFrame, value: str, passed: str) -> DataFrame:
    """Least and most by outcome, and the gap between the outcomes if they don't overlap."""
    g = df.agg(F.min(F.when(F.col(passed), F.col(value))).alias("pass_min"), F.max(F.when(F.col(passed), F.col(value))).alias("pass_max"), F.min(F.when(~F.col(passed), F.col(value))).alias("fail_min"), F.max(F.when(~F.col(passed), F.col(value))).alias("fail_max"))
    return g.withColumn("gap", F.when(F.col("pass_min") > F.col("fail_max"), F.col("pass_min") - F.col("fail_max")))
