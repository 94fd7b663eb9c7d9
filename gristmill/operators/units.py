"""Counts over an analyser's units (id, sentence, start, finish, lemma, tag): words, endings, lemmas that are not wanted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.functions.text import strip


def _base() -> Column:
    return F.substring_index("tag", "-", 1)


def word_counts(units: DataFrame, content: Sequence[str], nouns: Sequence[str]) -> DataFrame:
    """(id, tokens, distinct_tokens, nouns, diversity): units with a tag of content, and how many lemmas they have."""
    is_content = _base().isin(*content)
    g = units.groupBy("id").agg(F.count_if(is_content).alias("tokens"), F.countDistinct(F.when(is_content, F.col("lemma"))).alias("distinct_tokens"), F.count_if(_base().isin(*nouns)).alias("nouns"))
    return g.withColumn("diversity", F.coalesce(F.round(F.col("distinct_tokens") / F.nullif(F.col("tokens"), F.lit(0)), 6), F.lit(0.0)))


def top_words(units: DataFrame, content: Sequence[str], k: int = 15) -> DataFrame:
    """(id, rank, word, n, density) of each text's k commonest lemmas, ties by first appearance."""
    g = units.where(_base().isin(*content)).groupBy("id", F.col("lemma").alias("word")).agg(F.count(F.lit(1)).alias("n"), F.min("start").alias("at"))
    of_text = W.partitionBy("id")
    g = g.withColumn("density", F.round(F.col("n") / F.sum("n").over(of_text), 6)).withColumn("rank", F.row_number().over(of_text.orderBy(F.desc("n"), "at")))
    return g.where(F.col("rank") <= k).select("id", F.col("rank").cast("long").alias("rank"), "word", "n", "density")


def styles(sentences: DataFrame, endings: Sequence[tuple[str, str]]) -> DataFrame:
    """(id, sentences, mean_length, style, consistency) of (id, sentence, text): the commonest class of endings, ties by first
    appearance. A sentence has the first class that it matches; those without one don't count for the style."""
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(endings):
        kind = F.when(strip(F.col("text")).rlike(pattern), F.lit(name)).otherwise(kind)
    s = sentences.where(strip(F.col("text")) != "").withColumn("style", kind)
    g = s.groupBy("id", "style").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"), F.min("sentence").alias("at"))
    named = F.col("style").isNotNull()
    best = F.max_by("style", F.when(named, F.struct("n", (-F.col("at")).alias("at"))))
    share = F.max(F.when(named, F.col("n"))) / F.sum(F.when(named, F.col("n")))
    return g.groupBy("id").agg(F.sum("n").alias("sentences"), F.round(F.sum("chars") / F.sum("n"), 6).alias("mean_length"), F.coalesce(best, F.lit("")).alias("style"), F.coalesce(F.round(share, 6), F.lit(0.0)).alias("consistency"))


def lemma_hits(units: DataFrame, lemmas: DataFrame) -> DataFrame:
    """(id, start, finish, lemma, category, severity) of the units whose lemma is in (lemma, category, severity)."""
    return units.join(lemmas, "lemma").select("id", "start", "finish", "lemma", "category", "severity")


def argument_polarity(units: DataFrame, directions: DataFrame, lexicon: DataFrame, valences: DataFrame, negations: Sequence[str], nouns: Sequence[str], particles: Sequence[str], reach: int = 8, turn: int = 2) -> DataFrame:
    """(id, sentence, verb_at, verb, noun_at, noun, negated, score) of each verb of more or less in units (id, sentence, pos, lemma, tag).

    Its argument is the nearest noun before it, `reach` units back at most, that a particle follows; a particle is a unit with one of the
    tags particles. The score is the verb's direction (verb, direction) times the argument's valence: its own (word, valence), else
    the sign of its score in the lexicon (word, score), else 0. One of the negations in the `turn` units behind the verb turns the
    sign. A verb without an argument has no noun and scores 0. All of it is windows over a sentence and joins by word.
    """
    sentence = W.partitionBy("id", "sentence").orderBy("pos")
    is_argument = F.col("tag").isin(*nouns) & F.coalesce(F.lead("tag").over(sentence).isin(*particles), F.lit(False))
    u = units.select("id", "sentence", "pos", "lemma", "tag").withColumn("_arg", F.when(is_argument, F.struct("pos", "lemma")))
    u = u.withColumns({"_noun": F.max("_arg").over(sentence.rowsBetween(-reach, -1)), "_not": F.max(F.col("lemma").isin(*negations)).over(sentence.rowsBetween(1, turn))})
    v = u.join(directions.select(F.col("verb").alias("lemma"), "direction"), "lemma")
    v = v.select("id", "sentence", F.col("pos").alias("verb_at"), F.col("lemma").alias("verb"), F.col("_noun.pos").alias("noun_at"), F.col("_noun.lemma").alias("noun"), F.coalesce("_not", F.lit(False)).alias("negated"), "direction")
    v = v.join(valences.select(F.col("word").alias("noun"), "valence"), "noun", "left").join(lexicon.select(F.col("word").alias("noun"), F.signum(F.col("score").cast("double")).cast("int").alias("_sign")), "noun", "left")
    score = F.coalesce("valence", "_sign", F.lit(0)) * F.col("direction") * F.when(F.col("negated"), -1).otherwise(1)
    return v.select("id", "sentence", "verb_at", "verb", "noun_at", "noun", "negated", score.cast("int").alias("score"))
