"""Connected components of an edge table by smallest labels and pointer jumping, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import discard, save


def components(links: DataFrame, folder: str) -> DataFrame:
    """links: (a, b), any orderable type. Returns (node, root): root is the smallest node reachable, one row per linked node.

    The driver only ever sees one count a round. A round halves the distance to the root at least, so chains of
    length n take about log2(n) rounds. Null ends are dropped.
    """
    spark = links.sparkSession
    ends = links.where("a is not null and b is not null and a <> b")
    both = save(ends.select("a", "b").union(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{folder}/edges")
    label = save(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), f"{folder}/label0")
    k = 0
    while True:
        near = both.join(label.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lower = label.join(near, "node").select("node", "root", F.least("root", "near").alias("low"))
        hop = label.select(F.col("node").alias("low"), F.col("root").alias("far"))
        step = save(lower.join(hop, "low", "left").select("node", F.least("low", "far").alias("root"), (F.least("low", "far") < F.col("root")).alias("moved")), f"{folder}/label{k + 1}")
        discard(spark, f"{folder}/label{k}")
        k += 1
        label = step.select("node", "root")
        if step.where("moved").isEmpty():
            return label
