"""Budgets: prompts cut to a number of tokens by priority or from the tail, and a draft's length shared among its chapters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.text import strip

#: Tokens of a prompt, and terms that a negative prompt keeps whatever they cost.
BUDGET, LEAST_TERMS = 72, 10
WORD, POINT = r"[A-Za-z0-9']+", r"[,.:;()\-]"
#: What a text needs besides its chapters, and the least of a chapter.
FRAME, LEAST_CHAPTER = 650, 100


def _cost(words: Column, points: Column) -> Column:
    """Tokens of so many words and marks: 1.3 a word, half to even, and one a mark."""
    return (F.bround(words * F.lit(1.3)) + points).cast("long")


def approx_tokens(text: Column) -> Column:
    return _cost(F.regexp_count(text, F.lit(WORD)), F.regexp_count(text, F.lit(POINT)))


def clean_part(text: Column) -> Column:
    """Without white space at the ends and full stops at the end."""
    return strip(F.regexp_replace(strip(text), r"\.+$", ""))


def within_tokens(parts: Column, budget: int = BUDGET, least: int = 2, priorities: int = 7) -> Column:
    """Parts, an array of (priority, text) in the order of the text, joined by commas: the worst priority is dropped until the tokens fit
    or `least` parts are left. priorities: the worst there is."""
    empty = F.struct(F.lit(0).alias("n"), F.lit(0).alias("words"), F.lit(0).alias("points"))

    def of(p: int) -> tuple[Column, Column]:
        kept = F.filter(parts, lambda x: x["priority"] <= p)
        step = lambda a, x: F.struct((a["n"] + 1).alias("n"), (a["words"] + F.regexp_count(x["text"], F.lit(WORD))).alias("words"), (a["points"] + F.regexp_count(x["text"], F.lit(POINT)) + (a["n"] > 0).cast("int")).alias("points"))
        sums = F.aggregate(kept, empty, step)
        text = F.array_join(F.transform(kept, lambda x: x["text"]), ", ")
        return (_cost(sums["words"], sums["points"]) <= budget) | (sums["n"] <= least), text

    choices = [of(p) for p in range(priorities, 0, -1)]
    return F.coalesce(*(F.when(fits, text) for fits, text in choices), F.lit(""))


def prompt_parts(scene: Column, person: Column, domain: Column, mood: Column, shot: Column, texts: dict[str, str], markers: tuple[tuple[str, ...], tuple[str, ...]]) -> Column:
    """Parts (priority, text) of a picture's prompt: scene 1, dress or setting 2, whether there is somebody 3, place 4, style 5, mood 6, camera 7.

    texts: dress, place, setting, somebody, nobody, style. markers: words of a scene that make a place, and a setting, unnecessary.
    domain: whether the picture is of the domain that has a dress and a place. An empty scene has no parts.
    """
    own, low = clean_part(scene), F.lower(clean_part(scene))
    has = lambda words: reduce(Column.__or__, [F.contains(low, F.lit(w)) for w in words])
    part = lambda p, t, when=None: F.when(when if when is not None else F.lit(True), F.struct(F.lit(p).alias("priority"), (F.lit(t) if isinstance(t, str) else t).alias("text")))
    mood = F.coalesce(mood, F.lit(""))
    parts = F.array_compact(F.array(
        part(1, own), part(2, texts["dress"], domain & person), part(4, texts["place"], domain & person & ~has(markers[0])), part(2, texts["setting"], domain & ~person & ~has(markers[1])),
        part(3, F.when(person, F.lit(texts["somebody"])).otherwise(F.lit(texts["nobody"]))), part(5, texts["style"]), part(6, clean_part(mood), mood != ""), part(7, F.concat(shot, F.lit(" shot"))),
    ))
    return F.when(own != "", parts).otherwise(F.slice(parts, 1, 0))


def negative_terms(fixed: Column, asked: Column, conflicts: Column, budget: int = BUDGET, least: int = LEAST_TERMS) -> Column:
    """The fixed terms, then those asked for that are new, whatever their case, and in no conflict; the tail is cut until the tokens
    fit, but `least` terms stay."""
    named = lambda x, f: F.transform(F.array(x), f)[0]  # worked out once, where a lambda would do it again for each item
    asked = F.filter(F.transform(asked, strip), lambda t: t != "")
    known = F.concat(F.transform(fixed, F.lower), F.transform(conflicts, F.lower))
    rows = F.array_sort(F.transform(asked, lambda t, i: F.struct(F.lower(t).alias("low"), i.alias("i"), t.alias("t"))))
    # sorted, the first place of a term is the one whose neighbour before is another term
    first = lambda r, k: F.filter(r, lambda x, i: ((i == 0) | (F.get(r, i - 1)["low"] != x["low"])) & ~F.array_contains(k, x["low"]))
    fresh = named(known, lambda k: named(rows, lambda r: F.array_sort(F.transform(first(r, k), lambda x: F.struct(x["i"], x["t"])))))
    terms = F.concat(fixed, F.transform(fresh, lambda x: x["t"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("words"), F.lit(0).alias("points"), F.lit(0).alias("fits"))

    def step(a: Column, t: Column) -> Column:
        n, words = a["n"] + 1, a["words"] + F.regexp_count(t, F.lit(WORD))
        points = a["points"] + F.regexp_count(t, F.lit(POINT)) + (a["n"] > 0).cast("int")
        return F.struct(n.alias("n"), words.alias("words"), points.alias("points"), F.when((n <= least) | (_cost(words, points) <= budget), n).otherwise(a["fits"]).alias("fits"))

    # costs never fall with a further term, so the last number that fits is where cutting from the tail stops
    return named(terms, lambda all_: F.slice(all_, F.lit(1), F.aggregate(all_, start, step, lambda a: a["fits"])))


def chapter_share(target: Column, chapters: Column, frame: int = FRAME, least: int = LEAST_CHAPTER) -> Column:
    """Characters of each chapter: an equal share of what is left beside the frame, `least` at any rate; null without chapters."""
    return F.when(chapters > 0, F.greatest(F.lit(least), F.floor((target - frame) / chapters)).cast("long"))


def shares_with_floors(total: Column, floors: Column) -> Column:
    """The total dealt evenly over the items of an array of floors, none below its floor: those whose floor is above the level get their
    floor, the others share the rest, and what doesn't divide goes to the first of them. Floors are met even if they exceed the total.
    """
    n = F.size(floors)
    falling = F.reverse(F.array_sort(floors))
    # the highest floors are taken out while they are above an equal share of what is left
    start = F.struct(F.lit(0).alias("out"), total.cast("long").alias("rest"), F.lit(False).alias("done"))

    def step(a: Column, x: Column) -> Column:
        above = ~a["done"] & (x * (n - a["out"]) > a["rest"])
        return F.struct((a["out"] + above.cast("int")).alias("out"), F.when(above, a["rest"] - x).otherwise(a["rest"]).cast("long").alias("rest"), (a["done"] | ~above).alias("done"))

    end = F.aggregate(falling, start, step)
    level, left = F.floor(end["rest"] / F.nullif(n - end["out"], F.lit(0))), F.pmod(end["rest"], F.nullif((n - end["out"]).cast("long"), F.lit(0)))
    # an item shares if it isn't among those taken out; of equal floors the later ones are taken out
    order = F.transform(floors, lambda x, i: F.struct((-x).alias("x"), (-i).alias("i")))
    sharing = lambda x, i: F.array_position(F.array_sort(order), F.struct((-x).alias("x"), (-i).alias("i"))) > end["out"]
    nth = F.aggregate(F.transform(floors, lambda x, i: sharing(x, i)), F.array().cast("array<long>"), lambda a, s: F.concat(a, F.array(F.when(F.size(a) > 0, F.element_at(a, -1)).otherwise(0) + s.cast("long"))))
    return F.transform(floors, lambda x, i: F.when(sharing(x, i), level + (F.element_at(nth, i + 1) <= left).cast("long")).otherwise(x).cast("long"))
