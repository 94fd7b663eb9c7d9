"""The whole report of a draft in one row: structure, wording, style, sentiment and unwanted words; faults of single rows are rows too."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions.report import measured_structure, settings_of
from gristmill.functions.text import WHITE

MEASURES = ["title", "chapters", "body_chars", "lines", "short_share", "longest_line", "headings", "bullets", "images", "paragraphs", "longest_paragraph", "in_title", "in_head", "in_intro", "in_chapters"]


def quality_reports(drafts: DataFrame, words: DataFrame, top: DataFrame, styles: DataFrame, sentiment: DataFrame, banned: DataFrame, alt_white: str = WHITE) -> DataFrame:
    """(id, error, passed, banned, warnings, measures) of drafts (id, text, keyword, settings).

    words: (id, tokens, distinct_tokens, nouns, diversity). top: (id, rank, word, n, density). styles: (id, sentences, mean_length,
    style, consistency). sentiment: (id, negative). banned: (id, n, blocked). What a table lacks of a draft counts as nothing found.
    Settings that can't be read give the row an error and nothing else: no other row is touched. Empty drafts are left out.
    passed: no word of a blocking class; warnings never block. A warning tells what, and the figure that led to it.
    """
    d = drafts.where(F.coalesce("text", F.lit("")) != "").withColumn("_s", settings_of(F.col("settings"))).withColumns({"error": F.col("_s.error"), "_set": F.col("_s.value")}).drop("_s", "settings")
    d = measured_structure(d, "text", "keyword", "_set", alt_white).drop("text", "keyword")
    s = lambda name: F.col("_set")[name]
    d = d.join(words.select("id", "tokens", "nouns", "diversity"), "id", "left").join(styles.select("id", "mean_length", "style", "consistency"), "id", "left")
    d = d.join(sentiment.select("id", "negative"), "id", "left").join(banned.select("id", F.col("n").alias("banned"), "blocked"), "id", "left")
    # one row a draft of the words that are used too often, in the order of their rank
    limits = d.select("id", s("max_density").alias("most"), s("density_count").alias("least")).where(F.coalesce(F.col("nouns"), F.lit(0)) >= s("density_nouns"))
    often = top.join(limits, "id").where((F.col("density") > F.col("most")) & (F.col("n") >= F.col("least")))
    often = often.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rank", F.concat_ws(" ", F.lit("overused"), "word", F.col("n").cast("string")).alias("w")))).alias("o"))
    d = d.join(often.select("id", F.transform("o", lambda x: x["w"]).alias("_often")), "id", "left")
    mixed = (F.coalesce("style", F.lit("")) != "") & (F.col("consistency") < s("min_consistency"))
    own = F.array_compact(F.array(
        F.when((F.col("tokens") > 0) & (F.col("diversity") < s("min_diversity")), F.lit("few different words")), F.when(mixed, F.concat(F.lit("mixed style "), "style")),
        F.when(F.col("negative") > s("max_negative"), F.lit("negative")), F.when(F.col("mean_length") > s("max_sentence"), F.lit("long sentences")),
    ))
    none = F.array().cast("array<string>")
    warnings = F.concat(F.coalesce("_often", none), own, F.transform("structure_warnings", lambda w: F.concat(F.lit("structure: "), w)))
    fine = F.col("error").isNull()
    kept = lambda c: F.when(fine, c)
    return d.select("id", "error", kept(~F.coalesce("blocked", F.lit(False))).alias("passed"), kept(F.coalesce("banned", F.lit(0).cast("long"))).alias("banned"), kept(warnings).alias("warnings"), *(kept(F.col(c)).alias(c) for c in MEASURES), *(kept(F.col(c)).alias(c) for c in ("diversity", "style", "consistency", "mean_length", "negative")))
