"""Scans that accept rows in order under several quotas at once: of a picture's set, of a query, of a category's target.

A row is accepted if, of each of its keys, fewer rows than its quota were accepted before it. What one quota turns away leaves room
in the others, so no row's fate follows from its rank alone. The rows are decided in rounds of two kinds of decisions:

* Over all rows: a row is safe when, even if all open rows before it were accepted, each of its keys still had room; safe rows
  are accepted, and rows behind a key's last place are out.
* The next HEAD rows, before which all is decided, are read one by one in one task. So a long chain of rows of which each waits for
  the one before costs a round for HEAD rows, not for each row. Of a key that stops the scan only its first open rows are among them:
  the others are out if these fill it, and else the reading ends where they begin. So rows that aren't read cost no rounds.

A round needs one cut-off a key (the open row that would take its last place) instead of ranks of all rows: a minimum for quotas of
one, a limited window up to 1,000, which Spark prunes before the shuffle, and numbering by range beyond. Sets, queries and
categories may each hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.operators.greedy import cut
from gristmill.operators.ordering import numbered, running

#: Quotas up to this are found by a window that Spark limits before it shuffles.
LIMITED = 1000
#: Places of the order that a round reads one by one.
HEAD = 20_000


@dataclass(frozen=True)
class Quota:
    """At most so many accepted rows of one key.

    most: a number, or the name of a column that is the same in all rows of a key. taken: (key, n), places that are taken already.
    stops: rows behind a full key aren't read at all, so they have no other reason. first: named before a row's own reason.
    read: rows with a reason of their own take a place too, as they were read.
    """

    name: str
    key: str
    most: int | str
    taken: DataFrame | None = None
    stops: bool = False
    first: bool = False
    read: bool = False

    def limit(self) -> Column:
        return F.lit(self.most) if isinstance(self.most, int) else F.col(self.most)


def _cut_offs(open_: DataFrame, k: int, q: Quota, most: int) -> DataFrame:
    """(key, edge): the place of the open row that would take the last place of a key. Keys with room for all have no row."""
    taking = open_.where(F.col(f"k{k}").isNotNull() & (F.lit(True) if q.read else F.col("fine"))).select(F.col(f"k{k}").alias("key"), "seq", F.col(f"room{k}").alias("room"))
    if most <= 1:
        return taking.groupBy("key").agg(F.min("seq").alias("edge"))
    if most <= LIMITED:
        ranked = taking.withColumn("rn", F.row_number().over(W.partitionBy("key").orderBy("seq"))).where(F.col("rn") <= most)
    else:
        ranked = running(taking, ["key"], ["seq"], F.lit(1), "rn")
    return ranked.where(F.col("rn") == F.col("room")).select("key", F.col("seq").alias("edge"))


def _state(quota: Quota, k: int, won: DataFrame | None) -> DataFrame | None:
    """(key, n, last) of a quota: places taken, and the last row that took one (-1: before the scan)."""
    parts = [] if quota.taken is None else [quota.taken.select(F.col(quota.taken.columns[0]).cast("string").alias("key"), F.col(quota.taken.columns[1]).cast("long").alias("n"), F.lit(-1).cast("long").alias("last"))]
    if won is not None:
        took = won.where(F.col(f"k{k}").isNotNull() & (F.lit(True) if quota.read else F.col("fine")))
        parts.append(took.groupBy(F.col(f"k{k}").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.max("seq").alias("last")))
    if not parts:
        return None
    return reduce(DataFrame.unionAll, parts).groupBy("key").agg(F.sum("n").alias("n"), F.max("last").alias("last"))


def _with_room(rows: DataFrame, quotas: list[Quota], won: DataFrame | None) -> DataFrame:
    """rows with room<k> (places left of its k-th key) and last<k>."""
    for k, q in enumerate(quotas):
        state = _state(q, k, won)
        if state is None:
            rows = rows.withColumns({f"room{k}": F.col(f"m{k}"), f"last{k}": F.lit(-1).cast("long")})
            continue
        rows = rows.join(state.select(F.col("key").alias(f"k{k}"), F.col("n").alias("_n"), F.col("last").alias(f"last{k}")), f"k{k}", "left")
        rows = rows.withColumns({f"room{k}": F.col(f"m{k}") - F.coalesce("_n", F.lit(0)), f"last{k}": F.coalesce(f"last{k}", F.lit(-1))}).drop("_n")
    return rows


def _full(k: int) -> Column:
    return F.col(f"k{k}").isNotNull() & (F.col(f"room{k}") <= 0) & (F.col("seq") > F.col(f"last{k}"))


def _head(open_: DataFrame, quotas: list[Quota], size: int, stop: int | None, few: int) -> DataFrame:
    """(seq, head): whether each of the next `size` places is accepted. What comes before them is decided, so this is the scan itself.

    stop: a quota that stops the scan. Of each of its keys the first few open rows are read, and the next one tells where the others begin (past).
    """
    columns = ["seq", "fine", *(f"{c}{k}" for k in range(len(quotas)) for c in ("k", "room", "last"))]
    near = open_.select(*columns, F.lit(None).cast("long").alias("past"))
    if stop is not None:
        key = f"k{stop}"
        first = open_.where(F.col(key).isNotNull()).select("seq", key).withColumn("rn", F.row_number().over(W.partitionBy(key).orderBy("seq")))
        past = first.where(F.col("rn") <= few + 1).where(F.col("rn") == few + 1).select(key, F.col("seq").alias("past"))
        near = open_.select(columns).join(past, key, "left").where(F.col("past").isNull() | (F.col("seq") <= F.col("past"))).select(*columns, "past")
    takes = [q.read for q in quotas]

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(parts), ignore_index=True).sort_values("seq", ignore_index=True)
        room: list[dict] = [{} for _ in takes]
        won = []
        for seq, fine, *cells, past in rows.itertuples(index=False, name=None):
            left = {k: room[k].setdefault(cells[3 * k], cells[3 * k + 1]) > 0 or seq < cells[3 * k + 2] for k in range(len(takes)) if cells[3 * k] is not None}
            if past == seq and left[stop]:
                break  # the rows of this key that aren't here would be read
            won.append(None if past == seq else all(left.values()))
            if won[-1]:
                for k in left:
                    room[k][cells[3 * k]] -= bool(fine or takes[k])
        out = pd.DataFrame({"seq": rows["seq"][: len(won)], "head": pd.array(won, "boolean")})
        yield out[out["head"].notna()]

    return near.orderBy("seq").limit(size).repartition(1).mapInPandas(read, "seq long, head boolean")


def _few(most: int) -> int:
    """Open rows of a key with so large a quota that are read at once."""
    return 4 * most + 60


def scanned(df: DataFrame, order: list[Column | str], quotas: list[Quota], reason: Column | None = None) -> DataFrame:
    """df with verdict: accepted, or why not. reason: what is wrong with the row itself (null: nothing).

    A row's verdict is the first of: a full quota that stops the scan ("<name>"), a full quota that comes first, its own reason, a full
    quota. Null keys count for no quota. Rows that order doesn't tell apart come in any order, so it should tell all apart.
    """
    keys = {f"k{k}": F.col(q.key).cast("string") for k, q in enumerate(quotas)}
    limits = {f"m{k}": q.limit().cast("long") for k, q in enumerate(quotas)}
    placed = cut(numbered(df.withColumn("_reason", reason if reason is not None else F.lit(None).cast("string")), *order, into="_seq"))
    rows = placed.select(F.col("_seq").alias("seq"), F.col("_reason").isNull().alias("fine"), *(c.alias(n) for n, c in (keys | limits).items()))
    most = rows.agg(*(F.coalesce(F.max(f"m{k}"), F.lit(0)).alias(f"m{k}") for k in range(len(quotas))), *(F.approx_count_distinct(f"k{k}").alias(f"n{k}") for k in range(len(quotas)))).first()
    # of the quotas that stop the scan, the one with the most keys has the most rows that needn't be read
    stop = max((k for k, q in enumerate(quotas) if q.stops and _few(most[k]) < LIMITED), key=lambda k: most[f"n{k}"], default=None)
    # rows with a reason matter only to quotas that count what was read
    open_, won = cut(rows if any(q.read for q in quotas) else rows.where("fine")), None
    while True:
        open_ = _with_room(open_, quotas, won)
        open_ = cut(open_.where(~reduce(Column.__or__, [_full(k) for k in range(len(quotas))], F.lit(False))))
        if open_.isEmpty():
            break
        safe, marked = F.lit(True), open_
        for k, q in enumerate(quotas):
            edges = _cut_offs(open_, k, q, most[k]).select(F.col("key").alias(f"k{k}"), F.col("edge").alias(f"edge{k}"))
            marked = marked.join(edges, f"k{k}", "left")
            safe = safe & (F.col(f"k{k}").isNull() | F.col(f"edge{k}").isNull() | (F.col("seq") <= F.col(f"edge{k}")) | (F.col("seq") < F.col(f"last{k}")))
        marked = marked.withColumn("safe", safe).join(_head(open_, quotas, HEAD, stop, _few(most[stop]) if stop is not None else 0), "seq", "left")
        marked = cut(marked.select("seq", "fine", *keys, *limits, F.coalesce("head", "safe").alias("won"), (F.coalesce("head", "safe") | F.col("head").isNotNull()).alias("done")))
        new = marked.where("won").drop("won", "done")
        won, open_ = new if won is None else cut(won.union(new)), marked.where("not done").drop("won", "done")

    judged = _with_room(rows.withColumn("own", ~F.col("fine")), quotas, won)
    full = lambda test: [F.when(_full(k), F.lit(q.name)) for k, q in enumerate(quotas) if test(q)]
    taken = won.where("fine").select("seq", F.lit("accepted").alias("got")) if won is not None else rows.limit(0).select("seq", F.lit("accepted").alias("got"))
    judged = judged.join(taken, "seq", "left")
    early, late = full(lambda q: q.stops) + full(lambda q: q.first and not q.stops), full(lambda q: not q.stops and not q.first)
    judged = judged.select(F.col("seq").alias("_seq"), "got", F.coalesce(*early, F.lit(None).cast("string")).alias("_early"), F.coalesce(*late, F.lit(None).cast("string")).alias("_late"))
    verdict = F.coalesce("got", "_early", "_reason", "_late")
    # by a merge: judged has a row for each of placed, but so few bytes that it would be sent through the driver
    return placed.join(judged.hint("merge"), "_seq").select(*df.columns, verdict.alias("verdict"))


def stock(df: DataFrame, category: str, query: str) -> DataFrame:
    """(category, query, n): rows of each query, of each category (query null), and of all (both null). Rows found twice count twice."""
    return df.rollup(F.col(category).alias("category"), F.col(query).alias("query")).agg(F.count(F.lit(1)).alias("n"))
