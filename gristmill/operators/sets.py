"""First and last wins, pools, histories, carry-over and per-key caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_wins(df: DataFrame, key: str, seq: str) -> DataFrame:
    """The first row of each key. An aggregate, so that a hot key is thinned before the shuffle."""
    rest = [c for c in df.columns if c not in (key,)]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), seq).alias("_r")).select(key, "_r.*").select(df.columns)


def last_wins(df: DataFrame, key: str, seq: str) -> DataFrame:
    rest = [c for c in df.columns if c not in (key,)]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), seq).alias("_r")).select(key, "_r.*").select(df.columns)


def pool(df: DataFrame, key: str, seq: str) -> DataFrame:
    """One row a key: the place of the first, the values of the last."""
    rest = [c for c in df.columns if c not in (key, seq)]
    return df.groupBy(key).agg(F.min(seq).alias(seq), F.max_by(F.struct(*rest), seq).alias("_r")).select(key, seq, "_r.*").select(df.columns)


def without_history(df: DataFrame, history: DataFrame, key: str) -> DataFrame:
    return df.join(history.select(key).distinct(), key, "left_anti")


def merge_held(df: DataFrame, held: DataFrame, key: str, seq: str) -> DataFrame:
    """df and those of held whose key isn't in it; the first held row of a key wins."""
    return df.unionByName(first_wins(held, key, seq).join(df.select(key).distinct(), key, "left_anti").select(df.columns))


def held_entries(selected: DataFrame, done: DataFrame, before: DataFrame, key: str, seq: str, now: Column) -> DataFrame:
    """What was selected but not done, once a key; it keeps the time since which it is held."""
    rest = first_wins(selected.join(done.select(key).distinct(), key, "left_anti"), key, seq)
    return rest.join(before.groupBy(key).agg(F.min("held_since").alias("held_since")), key, "left").withColumn("held_since", F.coalesce("held_since", now))


def per_key_cap(df: DataFrame, key: str, seq: str, cap: int, prior: DataFrame | None = None) -> DataFrame:
    """At most cap rows a key in order, those that were stored before (key, n) counted."""
    if prior is not None:
        df = df.join(prior.select(key, F.col("n").alias("_prior")), key, "left")
    had = F.coalesce("_prior", F.lit(0)) if prior is not None else F.lit(0)
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(key).orderBy(seq))).where(F.col("_rn") + had <= cap).drop("_rn", "_prior")


def last_n(df: DataFrame, seq: str, n: int) -> DataFrame:
    """The n rows that came last: a bounded history. A top-n, not a sort of everything."""
    return df.orderBy(F.desc(seq)).limit(n)


def append_processed(history: DataFrame, batch: DataFrame, key: str, seq: str) -> DataFrame:
    """history and those of batch whose key isn't in it yet; repeats inside batch stay."""
    top = history.agg(F.coalesce(F.max(seq), F.lit(0)).alias("_top"))
    fresh = batch.join(history.select(key).distinct(), key, "left_anti").join(F.broadcast(top)).withColumn(seq, F.col(seq) + F.col("_top") + 1).drop("_top")
    return history.unionByName(fresh.select(history.columns))


def route(df: DataFrame, verdicts: DataFrame, key: str, seq: str, organisation: str, lanes: DataFrame, published: str, now: Column) -> DataFrame:
    """Records moved by their verdict: to the lane of organisations; from it to the lane of another verdict, or out.

    lanes: (lane, lookback_days). What moves into a lane with a shorter window must be inside it (unknown times are); in
    each lane the first record of a key stays. Adds moved_from.
    """
    v = last_wins(verdicts.withColumn("_s", F.monotonically_increasing_id()), key, "_s").select(key, "verdict") if verdicts.columns != [key, "verdict"] else verdicts
    # Rows that are inside the same windows fare alike whatever their verdict, so of those of a key and lane the first is enough: aggregates
    # without a sort, before anything is joined by key.
    days = lanes.agg(F.collect_set("lookback_days").alias("_days"))
    outside = F.when(F.col(published).isNotNull(), F.size(F.filter("_days", lambda d: F.col(published) < now - F.make_dt_interval(d))))
    rest = [c for c in df.columns if c not in ("lane", key, seq)]
    thin = df.join(F.broadcast(days)).groupBy(key, "lane", outside.alias("_outside")).agg(F.min(seq).alias(seq), *(F.min_by(c, seq).alias(c) for c in rest))
    r = thin.join(v, key, "left")
    target = F.when(F.col("verdict") == organisation, F.lit(organisation)).when(F.col("lane") == organisation, F.col("verdict")).otherwise(F.col("lane"))
    r = r.withColumn("moved_from", F.col("lane")).withColumn("lane", target).join(lanes, "lane")
    fresh = (F.col("lane") == F.col("moved_from")) | F.col(published).isNull() | (F.col(published) >= now - F.make_dt_interval(F.col("lookback_days")))
    w = W.partitionBy("lane", key).orderBy(seq)
    return r.where(fresh).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(*df.columns, "moved_from")


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old with the non-empty values of new written over; rows that only new has are added."""
    o, n = old.alias("o"), new.alias("n")
    keep = lambda c: F.nullif(F.col(f"n.{c}"), F.lit("")) if dict(new.dtypes).get(c) == "string" else F.col(f"n.{c}")
    columns = [F.coalesce(keep(c), F.col(f"o.{c}")).alias(c) if c in new.columns else F.col(f"o.{c}") for c in old.columns if c != key]
    return o.join(n, key, "full").select(key, *columns)


def retained(df: DataFrame, policy: DataFrame, created: str, now: Column) -> DataFrame:
    """df without what is older than its status allows (status, days); unknown times and statuses never expire."""
    return df.join(policy, "status", "left").where(F.col("days").isNull() | F.col(created).isNull() | (F.col(created) >= now - F.make_dt_interval(F.col("days")))).drop("days")
