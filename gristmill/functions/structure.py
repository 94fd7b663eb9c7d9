"""Structure and wording of drafts: lengths, headings, image slots, banned words, titles, rewrites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.functions.text import any_of, paragraphs, squash, strip


def prose_chars(text: Column) -> Column:
    """Characters of all lines without the white space at their ends: the one measure of length."""
    return F.aggregate(F.split(text, "\n"), F.lit(0).cast("long"), lambda a, x: a + F.length(strip(x)))


def length_tier(chars: Column, tiers: tuple[tuple[int, str], ...] = ((1200, "long"), (600, "middle"), (250, "short"), (0, "thin"))) -> Column:
    out = F.lit(None).cast("string")
    for least, name in reversed(tiers):
        out = F.when(chars >= least, name).otherwise(out)
    return out


def target_length(body: Column) -> Column:
    return F.greatest(F.lit(900), F.least(F.lit(1800), (F.length(body) * 1.8).cast("int")))


def within_length(text: Column, limit: int) -> Column:
    """Whole paragraphs while they fit; the first is cut if it alone is too long."""
    parts = F.split(text, "\n\n")
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("used"), F.lit(False).alias("over"))

    def step(a: Column, x: Column) -> Column:
        fits = ~a["over"] & (a["used"] + F.length(x) <= limit)
        return F.struct((a["n"] + fits.cast("int")).alias("n"), F.when(fits, a["used"] + F.length(x)).otherwise(a["used"]).alias("used"), (a["over"] | ~fits).alias("over"))

    kept = F.aggregate(parts, start, step, lambda a: a["n"])
    return F.when(kept > 0, F.array_join(F.slice(parts, F.lit(1), kept), "\n\n")).otherwise(F.substring(text, 1, limit))


def image_slots(text: Column) -> Column:
    """Lines of one or two digits alone."""
    return F.size(F.filter(F.split(text, "\n"), lambda x: strip(x).rlike(r"^\d{1,2}$"))).cast("long")


def filled_slots(drafts: DataFrame, images: DataFrame) -> DataFrame:
    """drafts (id, text) with the n-th slot line replaced by the n-th image (id, slot, image) of the draft, if there is one."""
    by_slot = images.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("slot", "image"))).alias("m"))
    lines = F.split("text", "\n")
    is_slot = lambda x: strip(x).rlike(r"^\d{1,2}$")
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("n"))

    def step(a: Column, x: Column) -> Column:
        n = a["n"] + is_slot(x).cast("int")
        image = F.when(is_slot(x) & F.col("m").isNotNull(), F.try_element_at(F.col("m"), n))
        return F.struct(F.concat(a["out"], F.array(F.coalesce(image, x))).alias("out"), n.alias("n"))

    return drafts.join(by_slot, "id", "left").select("id", F.aggregate(lines, start, step, lambda a: F.array_join(a["out"], "\n")).alias("text"))


def title_issues(title: Column, least: int = 17, most: int = 18, banned: str = r"[\"'“”‘’!…·,]") -> Column:
    return F.array_compact(F.array(F.when(~F.length(title).between(least, most), "length"), F.when(title.rlike(banned), "characters"), F.when(~F.endswith(title, F.lit("?")), "ending")))


def fixed_title(title: Column, banned: str = r"[\"'“”‘’!…·,]") -> Column:
    return strip(F.regexp_replace(F.regexp_replace(title, banned, ""), r"\s+", " "))


def rewritten(text: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The text after ordered rewrites, and how many places they changed."""
    count = F.lit(0).cast("long")
    for pattern, by in rules:
        count = count + F.regexp_count(text, F.lit(pattern))
        text = F.regexp_replace(text, pattern, by)
    return text, count


def structure(text: Column, keyword: Column) -> Column:
    """struct of counts and places: paragraphs, characters, title, where the keyword stands, warnings."""
    paras = paragraphs(text)
    title = F.coalesce(F.get(paras, F.lit(0)), F.lit(""))
    close, key = squash(title), squash(keyword)
    rest = F.array_join(F.slice(paras, F.lit(2), F.size(paras)), "\n")
    in_title, in_head = F.contains(close, key), F.contains(F.substring(close, 1, 15), key)
    in_intro = F.contains(squash(F.coalesce(F.get(paras, F.lit(1)), F.lit(""))), key)
    n = F.regexp_count(squash(rest), F.concat(F.lit("\\Q"), key, F.lit("\\E"))).cast("long")
    warnings = F.array_compact(F.array(F.when(~in_title, "title"), F.when(in_title & ~in_head, "head"), F.when(~in_intro, "intro"), F.when(n == 0, "body")))
    return F.struct(F.size(paras).cast("long").alias("paragraphs"), prose_chars(text).alias("chars"), title.alias("title"), in_title.alias("in_title"), in_head.alias("in_head"), in_intro.alias("in_intro"), n.alias("mentions"), warnings.alias("warnings"))


def banned_counts(df: DataFrame, column: str, categories: list[tuple[str, str, tuple[str, ...]]]) -> DataFrame:
    """df with blocked, and hits: the number of places for each category (name, severity, words)."""
    counts = F.create_map(*[x for name, _, words in categories for x in (F.lit(name), F.regexp_count(F.lower(F.col(column)), F.lit(any_of(words))).cast("long"))])
    df = df.withColumn("hits", counts)
    block = [F.col("hits")[name] > 0 for name, severity, _ in categories if severity == "block"]
    blocked = F.lit(False)
    for b in block:
        blocked = blocked | b
    return df.withColumn("blocked", F.coalesce(blocked, F.lit(False)))


def banned_places(df: DataFrame, column: str, categories: list[tuple[str, str, tuple[str, ...]]]) -> DataFrame:
    """(id, category, severity, start, finish, matched): places without overlaps inside a category; the longer first word wins.

    Offsets are running sums of the pieces between matches and the matches, as Spark tells no offsets of all matches; a window by row
    adds them up, so the cost is that of sorting a text's places. Texts, which may repeat an id, are told apart by a number.
    """
    out = None
    df = df.withColumn("_row", F.monotonically_increasing_id())
    upto = W.partitionBy("_row").orderBy("k").rowsBetween(W.unboundedPreceding, W.currentRow)
    for name, severity, words in categories:
        pattern = "(?i)" + any_of(tuple(sorted(words, key=lambda w: (-len(w), w))))
        hit = df.where(F.col(column).rlike(pattern)).select("id", "_row", F.regexp_extract_all(column, F.lit(f"({pattern})"), F.lit(1)).alias("m"), F.split(column, pattern, -1).alias("p"))
        pieces = F.zip_with(F.slice("p", F.lit(1), F.size("m")), "m", lambda p, m: F.struct(F.length(p).alias("p"), m.alias("t")))
        x = hit.select("id", "_row", F.posexplode(pieces).alias("k", "x")).select("id", "_row", "k", "x.p", "x.t")
        x = x.withColumn("finish", F.sum(F.col("p") + F.length("t")).over(upto))
        places = x.select("id", F.lit(name).alias("category"), F.lit(severity).alias("severity"), (F.col("finish") - F.length("t")).alias("start"), "finish", F.col("t").alias("matched"))
        out = places if out is None else out.union(places)
    return out


def source_chars(title: Column, body: Column, subtopics: Column) -> Column:
    """What a record has to tell, in characters: its trimmed body, its title and its subtopics."""
    return (F.length(strip(F.coalesce(body, F.lit("")))) + F.length(F.coalesce(title, F.lit(""))) + F.aggregate(subtopics, F.lit(0), lambda a, x: a + F.length(x))).cast("long")


def chapter_count(subtopics: Column, records: Column) -> Column:
    """A bundle's chapters: as many as its records have subtopics, or as records if they have none."""
    return F.when(subtopics > 0, subtopics).otherwise(records).cast("long")
