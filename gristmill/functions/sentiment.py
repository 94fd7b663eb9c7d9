"""Sentiment of sentences that an analyser has cut into units (lemma, tag, start, finish).

The analyser is the caller's: any that gives UNITS will do. simple_units cuts Latin text at letters, for tables without one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNITS = T.ArrayType(T.StructType([T.StructField("lemma", T.StringType()), T.StructField("tag", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("finish", T.IntegerType())]))
SCORE = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("matched", T.ArrayType(T.StringType()))])

# Tags that may carry sentiment alone, noun tags, particles of an argument, negations, and how far to look.
SCORED_TAGS = ("NNG", "NNP", "VV", "VA", "VX", "VCN", "MAG", "XR", "IC")
NOUN_TAGS, ARGUMENT_TAGS = ("NNG", "NNP"), ("JKS", "JX", "JKO", "JKC")
NEGATIONS = ("않다", "아니다", "없다", "못하다", "말다", "안", "못")
LONGEST, NEGATION_REACH, ARGUMENT_REACH = 3, 3, 8


@dataclass(frozen=True)
class Lexicon:
    """words: score of a lemma or of joined lemmas; directions: verbs of more (1) and less (-1); valences: whether more of a
    noun is good (1) or bad (-1); functional: words that mean nothing after a unit with one of these tags."""

    words: dict[str, int]
    directions: dict[str, int] = field(default_factory=dict)
    valences: dict[str, int] = field(default_factory=dict)
    functional: dict[str, tuple[str, ...]] = field(default_factory=dict)
    negations: tuple[str, ...] = NEGATIONS


def merged_lexicon(layers: DataFrame, neutral: DataFrame) -> DataFrame:
    """(word, score) of layers (word, score, priority): the highest priority counts, in it the score that is farthest from 0,
    of equals the larger; then words of neutral (word) go."""
    best = layers.groupBy("word").agg(F.max_by("score", F.struct("priority", F.abs("score"), "score")).alias("score"))
    return best.join(neutral.select("word").distinct(), "word", "left_anti")


def without_overlaps(units: list[dict], longer_wins: bool = False) -> list[dict]:
    """Units in order, the longer first at one start. Of overlapping ones the earlier stays, or the longer if longer_wins."""
    size = lambda u: u["finish"] - u["start"]
    out: list[dict] = []
    for u in sorted(units, key=lambda u: (u["start"], -size(u))):
        if not out or u["start"] >= out[-1]["finish"]:
            out.append(u)
        elif longer_wins and size(u) > size(out[-1]):
            out[-1] = u
    return out


def score_units(units: list[dict] | None, lex: Lexicon) -> tuple[float, list[str]]:
    """Sum and sources of a sentence's sentiment: first verbs of more and less by their argument, then the longest entries
    from left to right. A negation shortly after turns the sign. Units that an argument used up don't count again."""
    row = without_overlaps(list(units or []))
    lemmas, tags = [u["lemma"] for u in row], [u["tag"] for u in row]
    used, found, total = [False] * len(row), [], 0

    def add(name: str, score: int, after: int) -> int:
        turned = any(x in lex.negations for x in lemmas[after : after + NEGATION_REACH])
        found.append(f"{name}{'!' if turned else ''}:{-score if turned else score:+d}")
        return -score if turned else score

    for v, verb in enumerate(lemmas):
        if verb not in lex.directions:
            continue
        used[v] = True
        noun = next((i for i in range(v - 1, max(v - ARGUMENT_REACH, 0) - 1, -1) if tags[i] in NOUN_TAGS and tags[i + 1] in ARGUMENT_TAGS), None)
        if noun is None:
            total += add(verb, 0, v + 1)
            continue
        used[noun] = True
        known = lex.words.get(lemmas[noun]) or 0
        valence = lex.valences.get(lemmas[noun], (known > 0) - (known < 0))
        total += add(f"{lemmas[noun]}+{verb}", valence * lex.directions[verb], v + 1)
    at = 0
    while at < len(row):
        before = tags[at - 1] if at else None
        for n in range(min(LONGEST, len(row) - at), 0, -1):
            word = "".join(lemmas[at : at + n])
            alone = n > 1 or tags[at] in SCORED_TAGS
            if alone and not any(used[at : at + n]) and before not in lex.functional.get(word, ()) and word in lex.words:
                total += add(word, lex.words[word], at + n)
                at += n
                break
        else:
            at += 1
    return float(total), found


def sentence_scores(units: Column, lex: Lexicon) -> Column:
    """struct(score, matched) for an array of units."""

    @F.pandas_udf(SCORE)
    def score(column: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([score_units(list(u) if u is not None else [], lex) for u in column], columns=["score", "matched"])

    return score(units)


def simple_units(text: Column) -> Column:
    """Runs of Latin letters in lower case as nouns, with their places among the runs."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), F.lit(1))
    return F.transform(words, lambda w, i: F.struct(w.alias("lemma"), F.lit("NNG").alias("tag"), i.alias("start"), (i + 1).alias("finish")))


def document_sentiment(sentences: DataFrame, by: str, score: str, threshold: float = 0.0) -> DataFrame:
    """(by, sentences, positive, negative, neutral, mean, binary): shares of sentences; binary is null without a polar one."""
    up, down = F.count_if(F.col(score) > threshold), F.count_if(F.col(score) < -threshold)
    g = sentences.groupBy(by).agg(F.count(F.lit(1)).alias("sentences"), up.alias("up"), down.alias("down"), F.sum(score).alias("total"))
    part = lambda c: F.round(c / F.col("sentences"), 4)
    return g.select(by, "sentences", part(F.col("up")).alias("positive"), part(F.col("down")).alias("negative"), part(F.col("sentences") - F.col("up") - F.col("down")).alias("neutral"), part(F.col("total")).alias("mean"), (F.col("up") / F.nullif(F.col("up") + F.col("down"), F.lit(0))).alias("binary"))
