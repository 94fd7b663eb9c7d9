"""Selection lane by lane, its sweep, and the rows of bundles."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.config import Events
from gristmill.operators.events import all_overlaps, clusters, first_groups, representatives, same_event, signatures, tell_of
from gristmill.operators.events import grouped as in_events
from gristmill.operators.greedy import cut
from gristmill.operators.ordering import order_by_reports


def select_by_lane(members: DataFrame, pairs: DataFrame | None, lanes: Iterable[str], top: int, least_reports: int = 3, known: DataFrame | None = None, events: Events | None = None, sig: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(lane, place, id, leader, report_count, score) of the best of each lane, and (lane, id, leader) of all records they stand for.

    members: (id, lane, key, caption, chars, score), a record once for each of its lanes; pairs as similar_pairs gives them;
    lanes in the order in which they choose, a setting. A lane sees no record whose key, or whose event, an earlier lane
    took, and none of known (id). Records below a lane's top take nothing away from later ones. Instead of pairs, sig (id, token),
    or (id, tokens), may be given: then no table of pairs is made. Records are compared with the leaders of the first groups, until
    those that a lane chooses are known, and those of later lanes with what was taken.
    """
    e = events or Events()
    same = cut(pairs.where(same_event(e)).select("a", "b", "shared", "jaccard", "overlap")) if sig is None else None
    open_ = members if known is None else members.join(known.select("id").distinct(), "id", "left_anti")
    open_ = cut(open_)
    chosen, stand, lanes = [], [], list(lanes)
    for k, lane in enumerate(lanes):
        pool = open_.where(F.col("lane") == lane)
        if same is None:
            own = sig.join(pool.select("id"), "id", "left_semi")
            grouped = cut(in_events(pool, own, e) if least_reports <= 0 else first_groups(pool, own, top, least_reports, e))
        else:
            inside = same.join(pool.select(F.col("id").alias("a")), "a", "left_semi").join(pool.select(F.col("id").alias("b")), "b", "left_semi")
            grouped = cut(clusters(pool, inside, e))
        best = representatives(pool.join(grouped, "id"), e)
        placed = cut(order_by_reports(best.withColumn("seq", F.col("leader")), least_reports, "seq").where(F.col("place") <= top))
        of_those = cut(grouped.join(placed.select("leader"), "leader", "left_semi"))
        chosen.append(placed.select(F.lit(lane).alias("lane"), "place", "id", "leader", "report_count", "score"))
        stand.append(of_those.select(F.lit(lane).alias("lane"), "id", "leader"))
        if k + 1 == len(lanes):
            break
        # what was taken matters to the lanes that have yet to choose
        taken = cut(of_those.select("id").join(pool.select("id", "key"), "id"))
        open_ = open_.where(F.col("lane").isin(lanes[k + 1 :])).join(taken.select("key").distinct(), "key", "left_anti").join(taken.select("id").distinct(), "id", "left_anti")
        if same is None:
            open_ = cut(open_)
            met = tell_of(sig.join(open_.select("id"), "id", "left_semi"), sig.join(taken.select("id"), "id", "left_semi"), e)
        else:
            met = same.join(taken.select(F.col("id").alias("a")), "a").select(F.col("b").alias("id")).union(same.join(taken.select(F.col("id").alias("b")), "b").select(F.col("a").alias("id")))
        open_ = cut(open_.join(met.distinct(), "id", "left_anti"))
    return reduce(DataFrame.union, chosen), reduce(DataFrame.union, stand)


def likeness(chosen: DataFrame, tokens: DataFrame, events: Events | None = None, least: float = 0.05) -> DataFrame:
    """(lane, n, most, alike): how near the selected of each lane (lane, id) come to each other, by signatures of them alone.

    tokens: (id, tokens). The selected are few, as their number is a setting.
    """
    out = []
    for lane in [r.lane for r in chosen.select("lane").distinct().orderBy("lane").collect()]:
        own = tokens.join(chosen.where(F.col("lane") == lane).select("id"), "id")
        sig = cut(signatures(own, F.col("tokens"), events))
        near = all_overlaps(sig, sig).where("a < b").agg(F.coalesce(F.max("jaccard"), F.lit(0.0)).alias("most"), F.count_if(F.col("jaccard") >= least).alias("alike"))
        out.append(own.agg(F.lit(lane).alias("lane"), F.count(F.lit(1)).alias("n")).crossJoin(near))
    return reduce(DataFrame.union, out)


def lane_sweep(members: DataFrame, pairs: DataFrame | None, lanes: list[str], top: int, reports: Iterable[int], jaccards: Iterable[float], tokens: DataFrame, sig: DataFrame | None = None) -> DataFrame:
    """(least_reports, jaccard, lane, n, most, alike) of a selection for each setting; pairs hold all down to the lowest jaccard, or sig is given."""
    chosen = {(least, jaccard): cut(select_by_lane(members, pairs, lanes, top, least, events=replace(Events(), jaccard=jaccard), sig=sig)[0]) for least, jaccard in product(reports, jaccards)}
    # the tokens of all that were selected, so that the whole table isn't read for each setting and lane
    own = cut(tokens.join(reduce(DataFrame.union, chosen.values()).select("id").distinct(), "id", "left_semi"))
    named = lambda df, least, jaccard: df.select(F.lit(least).cast("long").alias("least_reports"), F.lit(jaccard).alias("jaccard"), "lane", "n", F.round("most", 6).alias("most"), "alike")
    return reduce(DataFrame.union, (named(likeness(rows, own), *setting) for setting, rows in chosen.items()))


def bundle_rows(packs: DataFrame, records: DataFrame, members: DataFrame, posts: int) -> tuple[DataFrame, DataFrame]:
    """One row a bundle, (lane, nth, bundle, kind, title, ids, members), and (lane, id) of the records held back.

    packs: (id, lane, bundle, kind); kind `held` is held, and so are bundles of a lane beyond its posts. records: (id, title);
    members: (id, leader) of what each record stands for. title: the first record's, and how many more there are.
    """
    own = packs.where("kind <> 'held'").join(records, "id").groupBy("lane", "bundle", "kind").agg(F.array_sort(F.collect_list(F.struct("id", "title"))).alias("r"))
    nth = F.row_number().over(W.partitionBy("lane").orderBy("bundle"))
    out = cut(own.withColumn("nth", nth).where(F.col("nth") <= posts).withColumn("nth", F.col("nth").cast("long")))
    told = packs.join(out.select("lane", "bundle"), ["lane", "bundle"]).select("lane", "bundle", F.col("id").alias("leader")).join(members, "leader")
    told = told.groupBy("lane", "bundle").agg(F.array_sort(F.collect_list("id")).alias("members"))
    more = F.size("r") - 1
    title = F.concat(F.col("r")[0]["title"], F.when(more > 0, F.concat(F.lit(" 외 "), more.cast("string"), F.lit("건"))).otherwise(""))
    rows = out.select("lane", "nth", "bundle", "kind", title.alias("title"), F.transform("r", lambda x: x["id"]).alias("ids")).join(told, ["lane", "bundle"], "left")
    held = packs.join(out.select("lane", "bundle"), ["lane", "bundle"], "left_anti").select("lane", "id")
    return rows.select("lane", "nth", "bundle", "kind", "title", "ids", "members"), held


def with_reason(df: DataFrame, rules: Iterable[tuple[str, Column]], into: str = "reason") -> DataFrame:
    """df with the name of the first rule that holds, else `open`; a rule that can't be judged doesn't hold."""
    out = F.lit("open")
    for name, holds in reversed(list(rules)):
        out = F.when(holds, F.lit(name)).otherwise(out)
    return df.withColumn(into, out)


def reset_notices(board: DataFrame, today: Column, body: str) -> DataFrame:
    """board (id, stamp, body) where notices of an earlier day, or of none, begin anew; run twice a day it changes nothing."""
    old = F.coalesce(F.col("stamp") < today, F.lit(True))
    return board.withColumns({"body": F.when(old, F.lit(body)).otherwise(F.col("body")), "stamp": F.when(old, today).otherwise(F.col("stamp"))})


def labels_merged(rows: DataFrame, told: DataFrame) -> DataFrame:
    """rows (id, label, by) with the labels told (id, seq, label), the last of each id, but for those that a person gave."""
    last = told.groupBy("id").agg(F.max_by("label", "seq").alias("_told"))
    own = F.coalesce(F.col("by") == "person", F.lit(False)) | F.col("_told").isNull()
    joined = rows.join(last, "id", "full")
    return joined.select("id", F.when(own, F.col("label")).otherwise(F.col("_told")).alias("label"), F.when(own, F.col("by")).otherwise(F.lit("model")).alias("by"))


def with_cached(texts: DataFrame, cache: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """texts with the vector that cache (key, vector) has under the SHA-1 of each, and (key, text) of those still to be encoded."""
    keyed = texts.withColumn("key", F.sha1(F.col(text_col)))
    new = keyed.join(cache, "key", "left_anti").groupBy("key").agg(F.first(text_col).alias(text_col))
    return keyed.join(cache, "key"), new
