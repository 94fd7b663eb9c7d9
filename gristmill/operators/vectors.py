"""Labelled vectors: class means, leave-one-out means, nearest-neighbour votes, near-equal pairs, one-to-one assignment."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.operators.greedy import cut


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def class_sums(df: DataFrame) -> DataFrame:
    """(label, n, total) of (label, v): one sum for each component, map-side combined."""
    parts = df.select("label", F.posexplode("v").alias("i", "x")).groupBy("label", "i").agg(F.sum(F.col("x").cast("double")).alias("x"), F.count(F.lit(1)).alias("n"))
    return parts.groupBy("label").agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("total"))


def _best(df: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, label, score, margin): the class with the highest similarity, and how far the second is."""
    w = W.partitionBy(id_col).orderBy(F.desc("sim"), "candidate")
    r = df.withColumn("rn", F.row_number().over(w)).where("rn <= 2").withColumn("next", F.lead("sim").over(w))
    return r.where("rn = 1").select(id_col, F.col("candidate").alias("label"), F.col("sim").alias("score"), (F.col("sim") - F.coalesce("next", F.lit(0.0))).alias("margin"))


#: Vectors of a block; anchors of a block, as so many times more, and how many of them are compared at once.
BLOCK, WIDE, STEP = 4096, 8, 2048


def _blocks(df: DataFrame, times: int = 1) -> tuple[DataFrame, int]:
    n = max(1, -(-df.count() // (BLOCK * times)))
    return df.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")), n


def neighbours(queries: DataFrame, anchors: DataFrame, k: int, least: float | None = None) -> DataFrame:
    """(id, other, label, sim): the k anchors (id, label, v) with the largest products for each query (id, v), not itself.

    Blocks of anchors meet blocks of queries, one task a pair of blocks, and the best of the blocks are merged. With least
    and k = 0 all pairs with sim > least and id < other.
    """
    a, na = _blocks(anchors.select("id", "label", "v"), WIDE)
    q, nq = _blocks(queries.select("id", "v"))
    q = q.select(F.col("id").alias("asked"), F.col("v").alias("asked_v"), "block")
    a = a.withColumn("with", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))
    q = q.withColumnRenamed("block", "with").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(na - 1))))

    def run(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if len(x) and len(y):
            asks, held = np.stack(x.asked_v).astype(float), np.stack(y.v).astype(float)
            ids, labels, asked = y.id.to_numpy(), y.label.to_numpy(), x.asked.to_numpy()
            edge, found = np.full((len(asked), 1), -np.inf), []
            for start in range(0, len(ids), STEP):
                sims, others = asks @ held[start : start + STEP].T, ids[start : start + STEP]
                if k and not start and k + 1 < len(others):
                    # the k best of all, without oneself, aren't below the k+1st of a part; ties stay too
                    edge = np.partition(np.where(np.isnan(sims), -np.inf, sims), len(others) - k - 1, axis=1)[:, [len(others) - k - 1]]
                row, at = np.nonzero(~(sims < edge) if k else sims > least)
                fits = others[at] != asked[row] if k else others[at] > asked[row]
                found.append((row[fits], at[fits] + start, sims[row[fits], at[fits]]))
            row, at, sim = (np.concatenate(c) for c in zip(*found, strict=True))
            if k:
                order = np.lexsort((ids[at], -sim, row))
                row, at, sim = row[order], at[order], sim[order]
                first = np.arange(len(row)) - np.searchsorted(row, row) < k
                row, at, sim = row[first], at[first], sim[first]
            return pd.DataFrame({"id": asked[row], "other": ids[at], "label": labels[at], "sim": sim})
        return pd.DataFrame({"id": [], "other": [], "label": [], "sim": []})

    found = q.groupBy("block", "with").cogroup(a.groupBy("block", "with")).applyInPandas(run, "id long, other long, label long, sim double")
    if not k:
        return found
    return found.withColumn("rn", F.row_number().over(W.partitionBy("id").orderBy(F.desc("sim"), "other"))).where(F.col("rn") <= k).drop("rn")


def centroid_predict(df: DataFrame, leave_out: bool = False) -> DataFrame:
    """Predicted class of (id, label, v) by the renormalised class means; with leave_out, a vector isn't part of its own mean.

    Blocks of vectors meet blocks of class sums, one task a pair of blocks; a task gives the best two classes of each vector, and
    those of its blocks are merged. A mean that is zero, and one's own class if nobody else is in it, takes no part.
    """
    q, nq = _blocks(df.select("id", "label", "v"))
    sums = class_sums(df).select(F.col("label").alias("id"), "n", "total")
    c, nc = _blocks(cut(sums))
    q = q.withColumnRenamed("block", "with").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(nc - 1))))
    c = c.withColumn("with", F.explode(F.sequence(F.lit(0), F.lit(nq - 1)))).withColumnRenamed("id", "candidate")

    def run(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"id": [], "candidate": [], "sim": []})
        if not len(x) or not len(y):
            return out
        v, total, names = np.stack(x.v).astype(float), np.stack(y.total).astype(float), y.candidate.to_numpy()
        products, size = v @ total.T, np.sqrt((total * total).sum(1))
        with np.errstate(divide="ignore", invalid="ignore"):
            sims = np.where(size > 0, products / size, -np.inf)
            if leave_out:
                at = np.array([np.flatnonzero(names == label)[0] if (names == label).any() else -1 for label in x.label])
                for i in np.flatnonzero(at >= 0):
                    rest = total[at[i]] - v[i]
                    length = np.sqrt(rest @ rest)
                    sims[i, at[i]] = rest @ v[i] / length if y.n.iloc[at[i]] > 1 and length > 0 else -np.inf
        order = np.lexsort((np.broadcast_to(names, sims.shape), -sims), axis=1)[:, :2]
        best = np.take_along_axis(sims, order, 1)
        keep = np.isfinite(best)
        return pd.DataFrame({"id": np.repeat(x.id.to_numpy(), keep.sum(1)), "candidate": names[order][keep], "sim": best[keep]})

    kind = {c_: t for c_, t in df.dtypes}
    return _best(q.groupBy("block", "with").cogroup(c.groupBy("block", "with")).applyInPandas(run, f"id {kind['id']}, candidate {kind['label']}, sim double"))


def knn_vote(queries: DataFrame, anchors: DataFrame, k: int = 5) -> DataFrame:
    """(id, label, score, margin): the class with the largest share of the k nearest anchors' positive similarities."""
    near = neighbours(queries, anchors, k).withColumn("w", F.greatest("sim", F.lit(0.0)))
    votes = near.groupBy("id", "label").agg(F.sum("w").alias("w")).withColumn("all", F.sum("w").over(W.partitionBy("id")))
    return _best(votes.select("id", F.col("label").alias("candidate"), F.coalesce(F.col("w") / F.nullif(F.col("all"), F.lit(0.0)), F.lit(0.0)).alias("sim")))


def vote_sweep(df: DataFrame, ks: list[int], centroid: bool = True) -> DataFrame:
    """(method, k, n, correct, sure): how many of (id, label, v) are told right by the others, for votes of each k and by class means (k null).

    sure: those told right by a margin of a tenth or more. The neighbours are looked for once, for the largest k; smaller ones are runs
    of the same table, so a sweep costs no search of its own.
    """
    near = cut(neighbours(df, df, max(ks)).withColumn("rn", F.row_number().over(W.partitionBy("id").orderBy(F.desc("sim"), "other"))).withColumn("w", F.greatest("sim", F.lit(0.0))))
    each = near.select("id", "label", "w", F.explode(F.filter(F.array(*(F.lit(k) for k in sorted(set(ks)))), lambda k: k >= F.col("rn"))).alias("k"))
    votes = each.groupBy("id", "k", "label").agg(F.sum("w").alias("w")).withColumn("all", F.sum("w").over(W.partitionBy("id", "k")))
    share = F.coalesce(F.col("w") / F.nullif(F.col("all"), F.lit(0.0)), F.lit(0.0))
    told = _best(votes.select(F.struct("id", "k").alias("id"), F.col("label").alias("candidate"), share.alias("sim"))).select("id.id", "id.k", F.lit("votes").alias("method"), F.col("label").alias("told"), "margin")
    if centroid:
        told = told.unionByName(centroid_predict(df, leave_out=True).select("id", F.lit(None).cast("int").alias("k"), F.lit("means").alias("method"), F.col("label").alias("told"), "margin"))
    right = F.col("told") == F.col("label")
    return told.join(df.select("id", "label"), "id").groupBy("method", "k").agg(F.count(F.lit(1)).alias("n"), F.count_if(right).alias("correct"), F.count_if(right & (F.col("margin") >= 0.1)).alias("sure"))


def near_equal(df: DataFrame, least: float) -> DataFrame:
    """(a, b, sim): pairs with a < b and a product of more than least."""
    return neighbours(df, df.withColumn("label", F.lit(0).cast("long")), 0, least).select(F.col("id").alias("a"), F.col("other").alias("b"), "sim")


def assign(pairs: DataFrame, least: float) -> DataFrame:
    """(q, i, sim): greedy one-to-one, the best remaining pair of (q, i, sim) first; pairs below least are left.

    In each round every pair that is the best of both its ends is taken; the greedy scan would take it too. Ties: smaller
    q, then smaller i.
    """
    left = cut(pairs.where(F.col("sim") >= least))
    taken = None
    while not left.isEmpty():
        order = F.struct((-F.col("sim")).alias("s"), "q", "i")
        best_q = left.groupBy("q").agg(F.min(order).alias("bq"))
        best_i = left.groupBy("i").agg(F.min(order).alias("bi"))
        won = cut(left.join(best_q, "q").join(best_i, "i").where((F.col("bq") == order) & (F.col("bi") == order)).select("q", "i", "sim"))
        taken = won if taken is None else taken.union(won)
        left = cut(left.join(won.select("q"), "q", "left_anti").join(won.select("i"), "i", "left_anti"))
    return taken if taken is not None else left.select("q", "i", "sim")


def assign_again(pairs: DataFrame, recent: DataFrame, picked: DataFrame, least: float) -> DataFrame:
    """(q, i, sim): assign without the recent and the picked (i); queries that got nothing may then have recent ones too."""
    free = cut(pairs.join(picked.select("i").distinct(), "i", "left_anti"))
    first = cut(assign(free.join(recent.select("i").distinct(), "i", "left_anti"), least))
    again = assign(free.join(first.select("q"), "q", "left_anti").join(first.select("i"), "i", "left_anti"), least)
    return first.select("q", "i", "sim").union(again.select("q", "i", "sim"))
