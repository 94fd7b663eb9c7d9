"""Order-dependent selections as rounds of joins.

"The first one wins, and what was dropped blocks nothing" is the lexicographically first maximal independent set of a
conflict graph: in each round a node wins if all its earlier neighbours have lost, and loses if an earlier neighbour won.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """A checkpoint in the folder that the session names; a local session without one gets a temporary folder."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="gristmill-"))
    return df.checkpoint()


def first_independent(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id) of the winners. edges: (a, b) with a before b; ids order the nodes."""
    edges = cut(edges.where("a < b").distinct())
    touched = edges.select(F.col("b").alias("id")).distinct()
    winners = cut(nodes.select("id").distinct().join(touched, "id", "left_anti"))
    open_ = edges
    while True:
        # losers: later neighbours of winners; what only losers blocked wins next
        lost = open_.join(winners.select(F.col("id").alias("a")), "a").select(F.col("b").alias("id")).distinct()
        open_ = cut(open_.join(lost.select(F.col("id").alias("b")), "b", "left_anti").join(lost.select(F.col("id").alias("a")), "a", "left_anti").join(winners.select(F.col("id").alias("a")), "a", "left_anti"))
        still = open_.select(F.col("b").alias("id")).distinct()
        left = touched.join(lost, "id", "left_anti")
        fresh = left.join(still, "id", "left_anti")
        winners, touched = cut(winners.union(fresh)), cut(left.join(fresh, "id", "left_anti"))
        if touched.isEmpty():
            return winners


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every node that has an edge (a, b): the smallest id reachable."""
    both = cut(edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select("b", "a")).distinct())
    label = cut(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("root")))
    while True:
        near = both.join(label.select(F.col("id").alias("b"), "root"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("near"))
        low = label.join(near, "id").select("id", "root", F.least("root", "near").alias("low"))
        step = cut(low.join(label.select(F.col("id").alias("low"), F.col("root").alias("far")), "low", "left").select("id", "root", F.least("low", "far").alias("next")))
        label = step.select("id", F.col("next").alias("root"))
        if step.where("next < root").isEmpty():
            return label


def two_key_dedupe(df: DataFrame, seq: str, first: str, second: str) -> DataFrame:
    """Rows of df kept when each row is dropped if either key was registered by an earlier kept row. Null keys are no keys.

    In each round a row wins that is the earliest open one of both its keys; then all open rows with a key of a winner are
    out. Rounds aggregate by key, so a key of any size costs one row a task and no pairs are made.
    """
    alone = df.where(F.col(first).isNull() & F.col(second).isNull()).select(F.col(seq).alias("id"))
    keyed = df.where(F.col(first).isNotNull() | F.col(second).isNotNull()).select(F.col(seq).alias("id"), F.col(first).alias("k1"), F.col(second).alias("k2"))
    open_ = cut(keyed.groupBy("k1", "k2").agg(F.min("id").alias("id")))  # of rows with equal keys only the first can win
    kept = alone
    while not open_.isEmpty():
        lead = lambda k: open_.where(F.col(k).isNotNull()).groupBy(k).agg(F.min("id").alias(f"first_{k}"))
        placed = open_.join(lead("k1"), "k1", "left").join(lead("k2"), "k2", "left")
        own = lambda k: F.coalesce(F.col(f"first_{k}") == F.col("id"), F.lit(True))
        won = cut(placed.where(own("k1") & own("k2")).select("id", "k1", "k2"))
        kept = kept.union(won.select("id"))
        taken = lambda k: won.where(F.col(k).isNotNull()).select(k)
        open_ = cut(open_.join(taken("k1"), "k1", "left_anti").join(taken("k2"), "k2", "left_anti").join(won.select("id"), "id", "left_anti").select("id", "k1", "k2"))
    return df.join(kept.select(F.col("id").alias(seq)), seq, "left_semi")


def leaders(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, leader): each node joins the smallest adjacent leader; leaders are the first independent set."""
    won = first_independent(nodes, edges)
    joined = edges.join(won.select(F.col("id").alias("a")), "a").where("a < b").groupBy(F.col("b").alias("id")).agg(F.min("a").alias("leader"))
    rest = nodes.select("id").distinct().join(won, "id", "left_anti").join(joined, "id")
    return won.select("id", F.col("id").alias("leader")).union(rest.select("id", "leader"))
