"""Why the gate decided as it did: the words found with where they stand, and two ways of counting held against each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.config import Config
from gristmill.functions.matching import gate, tokens, verdict

#: Fixed value: characters shown on either side of a word.
AROUND = 12


def first_place(text: Column, word: Column, around: int = AROUND) -> Column:
    """The text around the first place of a word, line ends as blanks; null where it doesn't stand."""
    at = F.instr(text, word) - 1
    start, end = F.greatest(at - around, F.lit(0)), F.least(at + F.length(word) + around, F.length(text))
    return F.when(at >= 0, F.replace(F.substring(text, start + 1, end - start), F.lit("\n"), F.lit(" ")))


def gate_reasons(df: DataFrame, config: Config, body: str = "body") -> DataFrame:
    """(id, gate, kind, word, place) of each core and generic word that stands in a record (id, title, body), and how the gate decided.

    A record without any has one row without a word. Words that are core and generic are core.
    """
    w = config.words
    text = F.concat_ws("\n", "title", body)
    listed = [(x, "core") for x in w.core] + [(x, "generic") for x in w.generic if x not in w.core]
    all_ = F.array(*(F.struct(F.lit(x).alias("word"), F.lit(k).alias("kind")) for x, k in listed))
    found = df.withColumns({"_text": text, "gate": verdict(gate(F.col("title"), F.col(body), config, {}), config.gate)})
    found = found.select("id", "gate", "_text", F.explode_outer(F.filter(all_, lambda x: F.contains(F.col("_text"), x["word"]))).alias("x"))
    return found.select("id", "gate", "x.kind", "x.word", F.when(F.col("x.kind") == "core", first_place(F.col("_text"), F.col("x.word"))).alias("place"))


def counting_differences(df: DataFrame, config: Config, body: str = "body") -> DataFrame:
    """(id, core, core_by_token, hits, hits_by_token, gate, gate_by_token): the gate on words that stand anywhere, and on the older count of
    distinct tokens with such a word in them."""
    w = config.words
    seen, titled = tokens(F.concat_ws("\n", "title", body), w), tokens(F.col("title"), w)
    holding = lambda ts, words: F.size(F.filter(F.array_distinct(ts), lambda t: F.exists(F.array(*(F.lit(x) for x in words)), lambda x: F.contains(t, x)))).cast("long")
    df = df.withColumns({"_facts": gate(F.col("title"), F.col(body), config, {}), "_seen": seen, "_titled": titled})
    domain = tuple(dict.fromkeys(w.core + w.generic))
    df = df.withColumns({"core_by_token": holding(F.col("_seen"), w.core), "hits_by_token": holding(F.col("_seen"), domain), "_has": holding(F.col("_titled"), w.core) > 0})
    older = F.col("_facts").withField("core", F.col("core_by_token")).withField("hits", F.col("hits_by_token")).withField("titled", F.col("_has"))
    return df.select("id", F.col("_facts.core").alias("core"), "core_by_token", F.col("_facts.hits").alias("hits"), "hits_by_token", verdict(F.col("_facts"), config.gate).alias("gate"), verdict(older, config.gate).alias("gate_by_token"))
