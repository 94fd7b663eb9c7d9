"""Tokens, vocabulary predicates and the topic gate, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.config import Config, Gate, Vocabulary
from gristmill.functions.text import any_of, squash


def strip_particle(token: Column, particles: tuple[str, ...]) -> Column:
    """Without the first particle of the list that ends the token and leaves two characters."""
    out = token
    for p in reversed(particles):
        out = F.when(F.endswith(token, F.lit(p)) & (F.length(token) - len(p) >= 2), F.substring(token, F.lit(1), F.length(token) - len(p))).otherwise(out)
    return out


def tokens(text: Column, words: Vocabulary, pattern: str | None = None) -> Column:
    """Noun-like tokens, repeats kept."""
    raw = F.regexp_extract_all(text, F.lit(f"({pattern or words.token})"), F.lit(1))
    bare = F.transform(raw, lambda t: strip_particle(t, words.particles))
    return F.filter(bare, lambda t: (F.length(t) >= 2) & ~t.isin(*words.stopwords) & ~t.rlike(words.verb_tail))


def signature_tokens(text: Column, words: Vocabulary) -> Column:
    """Distinct tokens that tell events apart: home-script words without particles, Latin words in lower case, years."""
    # equal ones go first, so that the rest is done once for each; a comparison of strings tells the first letter without a pattern
    raw = F.array_distinct(F.regexp_extract_all(text, F.lit(f"({words.signature})"), F.lit(1)))
    home = lambda t: (t >= "가") & (t < "\ud7a4")
    bare = F.transform(raw, lambda t: F.when(home(t), strip_particle(t, words.particles)).otherwise(F.lower(t)))
    return F.array_distinct(F.filter(bare, lambda t: ~home(t) | ((F.length(t) >= 2) & ~t.isin(*words.stopwords) & ~t.rlike(words.verb_tail))))


def types_in(text: Column, words: tuple[str, ...]) -> Column:
    """How many different words occur, as parts of words too."""
    return F.size(F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(text, w))).cast("long")


def spans_in(text: Column, words: tuple[str, ...]) -> Column:
    """Places at which words stand, overlapping or touching ones counted once.

    A split before each start gives all starts, and a look-ahead with the longest word first the reach of each.
    """
    longest = any_of(tuple(sorted(words, key=lambda w: (-len(w), w))))
    reach = F.transform(F.regexp_extract_all(text, F.lit(f"(?=({longest}))"), F.lit(1)), lambda w: F.length(w))
    pieces = F.split(text, f"(?={longest})")
    # the first piece is what stands before the first start; it is missing if the text begins with a word
    gaps = F.when(F.size(pieces) > F.size(reach), F.slice(pieces, F.lit(2), F.size(pieces))).otherwise(pieces)
    steps = F.zip_with(gaps, reach, lambda p, r: F.struct(F.length(p).alias("p"), r.alias("r")))
    start = F.struct(F.lit(0).alias("at"), F.lit(-1).alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda a, x: F.struct((a["at"] + x["p"]).alias("at"), F.greatest(a["end"], a["at"] + x["r"]).alias("end"), (a["n"] + F.when(a["at"] > a["end"], 1).otherwise(0)).cast("long").alias("n"))
    return F.aggregate(steps, start, step, lambda a: a["n"])


def mentions_of(text: Column, stem: str) -> Column:
    return F.regexp_count(text, F.lit(r"\Q" + stem + r"\E")).cast("long")


def incident_words(title: Column, body: Column, words: tuple[str, ...]) -> tuple[Column, Column]:
    """Sorted words in the title, and in the body but not the title. Two characters at most must stand unbroken; longer ones may have blanks inside."""
    bag = lambda c, s: F.array_sort(F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.when(F.length(w) <= 2, F.contains(c, w)).otherwise(F.contains(s, w))))
    in_title = bag(title, squash(title))
    return in_title, F.array_except(bag(body, squash(body)), in_title)


def gate(title: Column, body: Column, config: Config, limits: Gate | dict[str, Column] | None = None) -> Column:
    """struct(ok, gate, ...): whether a record is on topic, at which limit it failed, and the values looked at.

    Cheap tests come first. Limits may be Columns, so that one pass serves a sweep.
    """
    w = config.words
    text = F.concat_ws("\n", title, body)
    in_title, in_body = incident_words(title, body, w.crime)
    chars = F.length(body)
    core, spans, mentions = types_in(text, w.core), spans_in(text, w.core), mentions_of(text, w.stem)
    titled = title.rlike(any_of(w.core))
    hits = types_in(text, w.core + tuple(x for x in w.generic if x not in w.core))
    facts = F.struct(F.size(in_title).alias("title_incidents"), F.size(in_body).alias("body_incidents"), chars.alias("chars"), core.alias("core"), spans.alias("spans"), mentions.alias("mentions"), titled.alias("titled"), hits.alias("hits"))
    return facts if limits == {} else verdict(facts, limits or config.gate)


def verdict(facts: Column, limits: Gate | dict[str, Column]) -> Column:
    """The name of the first limit that the facts fail, or 'ok'."""
    g = (lambda k: limits[k] if k in limits else F.lit(getattr(Gate(), k))) if isinstance(limits, dict) else lambda k: F.lit(getattr(limits, k))
    f = lambda k: facts[k]
    per = lambda n: n / (f("chars") / 1000)
    by_types = (f("core") >= g("core_types")) & (f("spans") >= g("core_spans"))
    thin = (per(f("core")) < F.when(f("titled"), g("core_density")).otherwise(g("core_density_untitled"))) & (per(f("mentions")) < F.when(f("titled"), g("mention_density")).otherwise(g("mention_density_untitled")))
    return (
        F.when((f("title_incidents") > 0) | (f("body_incidents") >= g("incident_body_hits")), "incident")
        .when(f("chars") < g("body_chars"), "body")
        .when(~by_types & (f("mentions") < g("mentions")), "core")
        .when((f("chars") >= g("density_from_chars")) & thin, "density")
        .when(f("hits") < F.when(f("titled"), g("domain_hits")).otherwise(g("domain_hits_untitled")), "hits")
        .otherwise("ok")
    )
