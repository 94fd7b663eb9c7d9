"""Boards of pages by status, their pending contents, usage and provenance; the report over drafts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.drafts import base_name
from gristmill.functions.media import GENERATED, credit_by_name
from gristmill.operators.ordering import numbered


def pending(contents: DataFrame, articles: DataFrame, status: str) -> DataFrame:
    """(id, articles) of contents (id, status, ids) in a status: ids, a list joined by commas, becomes the array of those
    articles (key, ...) that are there, in its order. Contents without any are left out."""
    rows = contents.where(F.col("status") == status).select("id", F.posexplode(F.split("ids", ",")).alias("pos", "key"))
    rows = rows.select("id", "pos", F.trim("key").alias("key")).where("key <> ''")
    found = rows.join(articles, "key").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", *articles.columns))).alias("a"))
    return found.select("id", F.transform("a", lambda x: F.struct(*[x[c].alias(c) for c in articles.columns])).alias("articles"))


def with_status(board: DataFrame, changes: DataFrame) -> DataFrame:
    """board (id, status, ...) with the last change (id, seq, status) of each page written over its status."""
    last = changes.groupBy("id").agg(F.max_by("status", "seq").alias("_to"))
    return board.join(last, "id", "left").withColumn("status", F.coalesce("_to", "status")).drop("_to").select(board.columns)


def last_used(usage: DataFrame, fresh: DataFrame) -> DataFrame:
    """(key, at): when each was last used, before or now."""
    return usage.union(fresh.select(usage.columns)).groupBy("key").agg(F.max("at").alias("at"))


def recently_used(usage: DataFrame, now: Column, days: int = 14) -> DataFrame:
    """Keys used within so many days; an unknown time is an old one."""
    return usage.where(F.col("at") >= now - F.make_dt_interval(F.lit(days))).select("key")


def without_places(df: DataFrame, places: DataFrame) -> DataFrame:
    """df, numbered by rn from 1, without the rows at places (rn)."""
    return df.join(places.select("rn").distinct(), "rn", "left_anti")


def draft_verdicts(df: DataFrame) -> DataFrame:
    """df (id, blocked, banned, warnings, ...) with verdict: blocked, to be looked at, or fine."""
    return df.withColumn("verdict", F.when(F.col("blocked"), "blocked").when((F.col("banned") > 0) | (F.size("warnings") > 0), "look").otherwise("fine"))


def draft_summary(df: DataFrame) -> DataFrame:
    """One row of averages over judged drafts (chars, lines, short, longest, banned, warnings, verdict)."""
    share = F.sum("short") / F.nullif(F.sum("lines"), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("drafts"), F.round(F.avg("chars"), 4).alias("chars"), F.round(share, 6).alias("short_share"), F.max("longest").alias("longest"), F.sum("banned").alias("banned"), F.count_if(F.col("verdict") == "blocked").alias("blocked"), F.sum(F.size("warnings")).alias("warnings"))


def merged_options(have: DataFrame, wanted: DataFrame, renames: DataFrame) -> DataFrame:
    """(pos, name, change) of a board's options: those there (name, pos), renamed by renames (pos, old, new), then those wanted (name, pos) that are new.

    A name is changed only if nothing is called by the new one, there or by an earlier change; what people added stays. change: the old
    name, '+' for a new option, null for what stays as it is. Options keep their order; names are told once each.
    """
    free = renames.join(have.select(F.col("name").alias("new")), "new", "left_anti").join(have.select(F.col("name").alias("old")), "old", "left_semi")
    first = free.groupBy("new").agg(F.min_by("old", "pos").alias("old"), F.min("pos").alias("p")).groupBy("old").agg(F.min_by("new", "p").alias("new"))
    kept = have.join(first, have["name"] == first["old"], "left").select(F.lit(0).alias("part"), "pos", F.coalesce("new", "name").alias("name"), F.col("old").alias("change"))
    more = wanted.join(kept.select("name"), "name", "left_anti").select(F.lit(1).alias("part"), "pos", "name", F.lit("+").alias("change"))
    return numbered(kept.unionByName(more), "part", "pos", "name", into="rn").select((F.col("rn") - 1).alias("pos"), "name", "change")


def with_credits(pictures: DataFrame, provenance: DataFrame, rules: Sequence[tuple[str, str]], services: dict[str, str], providers: dict[str, dict[str, str]], drawn: Sequence[str] = ("generated",)) -> DataFrame:
    """pictures (source, original, ...) with credit: who is to be named for each; the empty string where nothing is known.

    A generated picture (a source in drawn) says so; one without an original has no credit. Else the original's name, without folders, is looked up
    in provenance (name, source, provider), a row a name: its service in services is the credit; a service in providers is told by its
    provider, in any case, or else by the entry ''; a service in drawn is generated; and for all else, and for names that aren't there,
    the first of rules (pattern, credit) that the name holds. Nothing is made up.
    """
    p = pictures.withColumn("_name", base_name(F.col("original")))
    known = provenance.select(F.col("name").alias("_known"), F.col("source").alias("_service"), F.lower(F.coalesce("provider", F.lit(""))).alias("_provider"))
    p = p.join(known, F.col("_name") == F.col("_known"), "left")
    credit = F.when(F.col("source").isin(*drawn), GENERATED).when(F.coalesce("original", F.lit("")) == "", "")
    for service, name in services.items():
        credit = credit.when(F.col("_service") == service, name)
    for service, names in providers.items():
        told = F.lit(names.get("", service))
        for provider, name in names.items():
            told = F.when((F.col("_provider") == provider) & (F.lit(provider) != ""), name).otherwise(told)
        credit = credit.when(F.col("_service") == service, told)
    credit = credit.when(F.col("_service").isin(*drawn), GENERATED).otherwise(credit_by_name(F.col("_name"), rules))
    return p.withColumn("credit", credit).drop("_name", "_known", "_service", "_provider")
