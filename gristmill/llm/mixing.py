"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words. Each of its documents has expected copies of its own: a weight that rises with
its words and levels off (words / (words + HALF)) times a factor of its source, cap at most, so that the expected words add
up to the target. Whole copies are certain. For the rest, documents are ranked by random odds over inclusion odds (Pareto
order sampling) and taken in that order as long as they fit what is left of the sample's words; one that doesn't fit is set
aside and the next are tried, in rounds, each a written table, until nothing fits. At last the smallest one left is taken if
that comes nearer to the target, so a source ends within half of its smallest document left. Ranks come from a hash of the
id, so reruns agree.

Cumulated words come from two levels: sums per source and slice of the rank scale, then running sums inside a slice. Slices
are equal steps of the logarithm of the rank, in which no document is denser than a logistic curve: whatever the odds, a
slice expects at most STEP / 4 of a source's documents. Words are runs of anything but ASCII white space.

Defined results: null text has size 0 and is never taken; null source is a source of its own, the last; a null id ranks
by a fixed value; rows that repeat each other rank by their order in a slice and each counts; sources without words get
target 0; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.llm.common import WORD, fresh, save, shared_dir

#: Width of a slice, on the scale of the logarithm of the rank.
STEP = 1 / 512
#: Words at which a document's weight is half of the greatest.
HALF = 64


def targets(sources: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size). Weights repeat over the sources in order, null last.

    The level L at which min(cap * size, weight * L) adds up to the total is the largest of those that follow from
    taking the first k sources by cap * size / weight as capped. One row a source: windows over it are small.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    w = sources.withColumn("place", place).withColumn("weight", F.element_at(cycle, ((F.col("place") - 1) % len(weights) + 1).cast("int")))
    by_fill = W.orderBy(F.col("source_size") / F.col("weight"), "place")
    before, rest, whole = by_fill.rowsBetween(W.unboundedPreceding, -1), by_fill.rowsBetween(0, W.unboundedFollowing), W.partitionBy()
    level = (F.lit(share) * F.sum("source_size").over(whole) - F.lit(cap) * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(rest)
    w = w.withColumn("level", level).withColumn("top", F.max("level").over(whole))
    return w.select("source", "source_size", F.least(F.lit(cap) * F.col("source_size"), F.col("weight") * F.col("top")).alias("target"))


def _uniform(key: Column, seed: int) -> Column:
    digits = F.substring(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f":{seed}"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**52)


def _without(rows: DataFrame, got: DataFrame) -> DataFrame:
    g = got.select(F.col("source").alias("s"), F.col("slice").alias("l"), F.col("order").alias("o"))
    return rows.join(g, rows["source"].eqNullSafe(g["s"]) & (rows["slice"] == g["l"]) & (rows["order"] == g["o"]), "left_anti")


def expected_copies(sizes: DataFrame, cap: float, half: float = HALF) -> DataFrame:
    """(source, size, n, target, expected) from (source, size, n, target), n documents of each size above 0.

    expected is min(cap, factor * size / (size + half)), and the source's factor makes the sum of n * size * expected its
    target. The factor is the largest of those that follow from taking the k largest sizes as capped: the sum of minima is
    no more than any sum in which each document takes one side, so none of them is above the true one.
    """
    words = F.col("n") * F.col("size")
    weight = F.col("size") / (F.col("size") + F.lit(float(half)))
    down = W.partitionBy("source").orderBy(F.desc("size"))
    before, rest = down.rowsBetween(W.unboundedPreceding, -1), down.rowsBetween(0, W.unboundedFollowing)
    factor = (F.col("target") - F.lit(cap) * F.coalesce(F.sum(words).over(before), F.lit(0))) / F.sum(words * weight).over(rest)
    expected = F.greatest(F.least(F.lit(float(cap)), F.col("factor") * weight), F.lit(0.0))
    near = F.when(F.abs(F.col("e") - F.round("e")) < 1e-9, F.round("e")).otherwise(F.col("e"))  # what rounding left over
    out = sizes.withColumn("factor", factor).withColumn("factor", F.max("factor").over(W.partitionBy("source")))
    return out.withColumn("e", expected).select("source", "size", "n", "target", near.alias("expected"))


def mixed(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, source, expected, mark) of each row of docs; mark is a hash of the whole row."""
    spark, folder = docs.sparkSession, shared_dir(docs.sparkSession, "mix")
    size = F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = save(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), size.alias("size"), row_mark(docs).alias("mark")), f"{folder}/rows")
    sizes = save(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), f"{folder}/sizes")
    goal = save(targets(sizes.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, share, cap), f"{folder}/targets")

    # sources are joined by value with null as a value; Spark splits the large one (adaptive skew join) or sends the few sources out
    t = goal.select(F.col("source").alias("s"), "source_size", "target")
    h = sizes.where("size > 0").join(t, sizes["source"].eqNullSafe(t["s"])).select("source", "size", "n", "target")
    e = save(expected_copies(h, cap), f"{folder}/expected")
    needs = e.groupBy(F.col("source").alias("s2")).agg((F.max("target") - F.sum(F.col("n") * F.col("size") * F.floor("expected"))).alias("need"))
    e = e.select(F.col("source").alias("s3"), F.col("size").alias("z"), "expected")
    r = rows.join(t, rows["source"].eqNullSafe(t["s"]), "left").join(needs, rows["source"].eqNullSafe(needs["s2"]), "left")
    r = r.join(e, rows["source"].eqNullSafe(e["s3"]) & (rows["size"] == e["z"]), "left").drop("s", "s2", "s3", "z")
    r = r.withColumn("expected", F.coalesce("expected", F.lit(0.0))).withColumn("whole", F.floor("expected")).withColumn("odd", F.col("expected") - F.col("whole"))
    u = _uniform(F.col("doc_id"), seed)
    # the logarithm of random odds over inclusion odds
    q = F.log(u / (1 - u)) - F.log(F.col("odd") / (1 - F.col("odd")))
    r = r.withColumn("rank", F.when((F.col("odd") > 0) & (F.col("size") > 0), q)).withColumn("slice", F.floor(F.col("rank") / STEP))
    inside = W.partitionBy("source", "slice").orderBy("rank", "doc_id", "mark")
    ranked = r.where("rank is not null").withColumn("order", F.row_number().over(inside)).withColumn("run", F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0)))
    ranked = save(ranked, f"{folder}/ranked")
    sliced = ranked.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    base = sliced.withColumn("base", F.coalesce(F.sum("words").over(W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select(F.col("source").alias("s"), F.col("slice").alias("l"), "base")
    ranked = save(ranked.join(base, ranked["source"].eqNullSafe(base["s"]) & (ranked["slice"] == base["l"])).withColumn("sampled", F.col("base") + F.col("run") <= F.col("need")).drop("s", "l"), f"{folder}/placed")

    # what doesn't fit is set aside; the prefix step is repeated over what fits the gap that is left, until nothing does
    gap = save(ranked.groupBy("source").agg((F.max("need") - F.coalesce(F.sum(F.when(F.col("sampled"), F.col("size"))), F.lit(0))).alias("gap")), f"{folder}/gap")
    left = save(ranked.where(~F.col("sampled")).select("source", "slice", "order", "size"), f"{folder}/left")
    opened, rounds = left, []
    while True:
        at = f"{folder}/round{len(rounds)}"
        g = gap.select(F.col("source").alias("s"), "gap")
        fits = save(opened.join(g, opened["source"].eqNullSafe(g["s"])).where(F.col("size") <= F.col("gap")).drop("s"), f"{at}/fits")
        # only the slices that begin inside the gap can hold documents to take
        words = fits.groupBy("source", "slice").agg(F.sum("size").alias("words"), F.max("gap").alias("room"))
        start = F.coalesce(F.sum("words").over(W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        base = words.withColumn("base", start).where("base < room").select(F.col("source").alias("s"), F.col("slice").alias("l"), "base")
        near = fits.join(base, fits["source"].eqNullSafe(base["s"]) & (fits["slice"] == base["l"])).drop("s", "l")
        run = F.sum("size").over(W.partitionBy("source", "slice").orderBy("order").rowsBetween(W.unboundedPreceding, 0))
        got = save(near.withColumn("run", run).where(F.col("base") + F.col("run") <= F.col("gap")).select("source", "slice", "order", "size"), f"{at}/got")
        if got.isEmpty():
            break
        rounds.append(got)
        used = got.groupBy(F.col("source").alias("s")).agg(F.sum("size").alias("used"))
        gap = save(gap.join(used, gap["source"].eqNullSafe(used["s"]), "left").select("source", (F.col("gap") - F.coalesce("used", F.lit(0))).alias("gap")), f"{at}/gap")
        opened = _without(fits.drop("gap"), got)

    # all that is left is larger than its gap: the smallest is taken if that comes nearer
    if rounds:
        left = _without(left, reduce(DataFrame.union, rounds))
    g = gap.select(F.col("source").alias("s"), "gap")
    last = left.groupBy("source").agg(F.min(F.struct("size", "slice", "order")).alias("p"))
    last = last.join(g, last["source"].eqNullSafe(g["s"])).where((F.col("gap") > 0) & (F.col("p.size") - F.col("gap") < F.col("gap"))).select("source", "p.slice", "p.order", "p.size")
    picks = save(reduce(DataFrame.union, rounds, last), f"{folder}/picks")
    picks = picks.select(F.col("source").alias("s"), F.col("slice").alias("l"), F.col("order").alias("o"), F.lit(True).alias("picked"))
    chosen = ranked.join(picks, ranked["source"].eqNullSafe(picks["s"]) & (ranked["slice"] == picks["l"]) & (ranked["order"] == picks["o"]), "left")
    of_rank = chosen.withColumn("copies", F.col("whole") + (F.col("sampled") | F.coalesce("picked", F.lit(False))).cast("int"))
    columns = ["doc_id", "size", "source_size", "target", "copies", "source", "expected", "mark"]
    both = of_rank.select(columns).union(r.where("rank is null").withColumn("copies", F.when(F.col("size") > 0, F.col("whole")).otherwise(F.lit(0))).select(columns))
    return both.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), F.col("copies").cast("int").alias("copies"), "source", "expected", "mark")


def row_mark(docs: DataFrame) -> Column:
    """A hash of all columns of a row, nulls told apart."""
    columns = [(F.to_json(f"`{c}`") if "map<" in kind else F.col(f"`{c}`")) for c, kind in docs.dtypes]
    return F.xxhash64(*columns, *[c.isNull() for c in columns])


def take(docs: DataFrame, **settings) -> DataFrame:
    """The rows of docs, each as often as the mix takes it. Rows that are equal in all columns are one row with their copies added."""
    id_col = settings.get("id_col", "doc_id")
    copies = mixed(docs, **settings).where("copies > 0").groupBy("doc_id", "mark").agg(F.sum("copies").cast("int").alias("n"))
    row, key, mark, n, k = fresh(docs, "row", "key", "mark", "n", "k")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), F.col(f"`{id_col}`").alias(key), row_mark(docs).alias(mark))
    of = copies.select(F.col("doc_id").alias("k1"), F.col("mark").alias("m1"), F.col("n").alias(n))
    rows = keyed.join(of, keyed[key].eqNullSafe(of["k1"]) & (keyed[mark] == of["m1"])).groupBy(key, mark).agg(F.first(row).alias(row), F.first(n).alias(n))
    return rows.select(F.col(row), F.explode(F.sequence(F.lit(1), F.col(n))).alias(k)).select(f"{row}.*")
