"""Pictures and their words: credits, texts for readers who don't see them, names kept out of prompts, lane settings, replies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.text import strip

# What is told of generated pictures, and the prepositions that are left over when a name goes.
GENERATED = "AI 생성 이미지"
CREDIT, CREDIT_TOO, CREDIT_ONLY = "이미지 출처: ", " · 일부 삽화는 AI로 만들었어요.", "삽화는 AI로 만들었어요."
LOOSE = r"(?i)(?<![\p{L}\p{N}_])(?:at|in|on|during|from|of|near|by)(?:\s+the)?(?=\s*[,.]|\s*$)"
#: How often what is left over is cleaned again.
ROUNDS = 4


def credit_by_name(name: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The credit of the first pattern that the lower-case name holds; without one, the empty string."""
    low, out = F.lower(name), F.lit("")
    for pattern, credit in reversed(rules):
        out = F.when(low.rlike(pattern), F.lit(credit)).otherwise(out)
    return out


def credit_line(credits: Column, generated: str = GENERATED) -> Column:
    """One sentence of an array of credits: each once, in order, and that some or all pictures are generated."""
    own = F.array_distinct(F.filter(credits, lambda c: (c != "") & (c != generated)))
    drawn, named = F.array_contains(credits, generated), F.concat(F.lit(CREDIT), F.array_join(own, ", "))
    return F.when(F.size(own) == 0, F.when(drawn, CREDIT_ONLY).otherwise("")).otherwise(F.concat(named, F.when(drawn, CREDIT_TOO).otherwise("")))


def alt_text(heading: Column, keywords: Column, generated: Column, default: str) -> Column:
    """The heading with at most three keywords; generated pictures say so, and so do those of which nothing is known (null)."""
    some = F.slice(F.coalesce(keywords, F.array().cast("array<string>")), 1, 3)
    base = F.concat(strip(F.coalesce(F.nullif(heading, F.lit("")), F.lit(default))), F.when(F.size(some) > 0, F.concat(F.lit(" ("), F.array_join(some, ", "), F.lit(")"))).otherwise(""))
    return F.concat(base, F.when(F.coalesce(generated, F.lit(True)), f" — {GENERATED}").otherwise(""))


def named(items: Column, common: Sequence[str]) -> Column:
    """Items without blanks and common words."""
    bare = F.filter(F.transform(items, strip), lambda t: t != "")
    return F.filter(bare, lambda t: ~F.lower(t).isin(*common) & ~t.isin(*common)) if common else bare


def all_terms(groups: Column) -> Column:
    """Distinct terms of two characters or more of an array of arrays, the longest first, then by code points."""
    terms = F.array_distinct(F.filter(F.transform(F.flatten(groups), strip), lambda t: F.length(t) >= 2))
    return F.transform(F.array_sort(F.transform(terms, lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t")))), lambda x: x["t"])


def without_terms(text: Column, terms: Column) -> Column:
    """text without the terms, in either case and in their order, and without what has lost its object then."""
    out = F.aggregate(terms, text, lambda t, term: F.regexp_replace(t, F.concat(F.lit(r"(?iu)\Q"), F.replace(term, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E")), F.lit("")))
    clean = out
    for _ in range(ROUNDS):
        clean = F.regexp_replace(F.regexp_replace(clean, r"\s{2,}", " "), r"\s+([,.])", "$1")
        clean = F.btrim(F.regexp_replace(F.regexp_replace(clean, LOOSE, ""), r"(?:\s*,){2,}", ","), F.lit(" ,."))
    return F.when(out == text, F.btrim(text, F.lit(" ,."))).otherwise(clean)


def chain(first: Column, others: Column, spent: Column) -> Column:
    """What is tried one after the other: each once, without what is spent."""
    return F.array_except(F.array_distinct(F.filter(F.concat(F.array(first), others), lambda x: x != "")), spent)


def rotating(pool: Column, turn: Column) -> Column:
    """The entry of pool whose turn it is."""
    return F.element_at(pool, (F.pmod(turn, F.size(pool)) + 1).cast("int"))


def lanes_of(spec: Column, display: int, lookback: int, most: int = 100) -> Column:
    """array of struct(name, keywords, display, lookback) from `name:word,word:display:lookback | ...`.

    A number that can't be read becomes the default; a lane without words has its name as the word; without any lane, null.
    """

    def lane(chunk: Column) -> Column:
        part = F.transform(F.split(chunk, ":"), strip)
        words = F.filter(F.transform(F.split(F.coalesce(F.get(part, F.lit(1)), F.lit("")), ","), strip), lambda w: w != "")
        number = lambda k, default: F.coalesce(F.get(part, F.lit(k)).try_cast("int"), F.lit(default))
        given = F.coalesce(F.get(part, F.lit(1)), F.lit("")) != ""
        return F.struct(part[0].alias("name"), F.when(given, words).otherwise(F.array(part[0])).alias("keywords"), F.least(F.greatest(number(2, display), F.lit(1)), F.lit(most)).alias("display"), F.greatest(number(3, lookback), F.lit(1)).alias("lookback"))

    found = F.filter(F.transform(F.split(spec, r"\|"), lane), lambda x: x["name"] != "")
    return F.when(F.size(found) > 0, found)


def replies(text: Column, labels: Sequence[str], n: Column) -> Column:
    """array of struct(i, label, why) of a reply in JSON, fenced or not: known labels at places 1 to n; null if it can't be read."""
    bare = F.regexp_replace(F.regexp_replace(strip(text), r"^```(?:json)?", ""), r"```$", "")
    items = F.from_json(bare, "array<struct<i:string,label:string,why:string>>")
    told = F.transform(items, lambda x: F.struct(x["i"].try_cast("int").alias("i"), strip(x["label"]).alias("label"), F.substring(F.coalesce(x["why"], F.lit("")), 1, 40).alias("why")))
    return F.filter(told, lambda x: (x["i"] >= 1) & (x["i"] <= n) & x["label"].isin(*labels))


def regrouped(groups: Column, edited: Column) -> Column:
    """The edited array cut into pieces as long as groups, an array of arrays; null if there are more or fewer entries."""
    before = lambda i: F.aggregate(F.slice(groups, F.lit(1), i), F.lit(0), lambda n, g: n + F.size(g))
    return F.when(F.size(F.flatten(groups)) == F.size(edited), F.transform(groups, lambda g, i: F.slice(edited, before(i) + 1, F.size(g))))
