"""Audit of how sources differ: a divergence between the sources of a language, and the terms that set each source apart.

A term is a run of ASCII letters and of bytes from 0x80 on, A-Z lower-cased. A language keeps the terms of at least least_docs of its
documents. A source's probability of a kept term is p = 1 + floor(10**9 * (count + 1) / (N + V)) with N its occurrences of kept terms
and V their number; a term's part of the divergence of p from q is floor((p - q)**2 / q). All of it is whole numbers.

1. A task takes the UTF-8 buffer of many texts at once: a lookup table of 256 bytes lower-cases and finds the borders of terms, xxhash
   groups the slices, and each slice is compared byte by byte with the first of its group, so that equal hashes of unlike terms
   are told apart. Sorted (document, term) places are a CSR matrix whose runs reduceat adds up by source.
2. Counts are added before and after the shuffle by (language, source, term); a window by (language, term) drops rare terms.
3. Terms are dealt by hash over slots of about SLOT_ROWS counts, so that no language or source is in one task. Each slot also gets
   the list of sources with their totals in front of the terms.
4. A slot builds a CSR matrix of terms by sources. For each source, all entries of the others are compared at once and reduceat adds
   them up by source; terms that another source lacks differ only by the count in the first, so they are added up by distinct count.
   The slot's sums are added over all slots; its best `top` terms a source suffice for the overall best.

The table of pairs has the square of the number of sources of a language: that is its meaning.

Defined results: null text, language and source are ''; a text without terms counts for its group alone; a group without terms is in
all pairs of its language (0 if the language keeps no term). Repeated rows are documents each. Ties are sorted by the item's bytes.
Very long texts are taken whole. An empty table has an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.common import save, shared_dir, text_chunks

SCALE = 10**9
#: Bytes of text that a task takes at a time, and slices it hashes or compares at a time.
TEXT_BYTES, SLICES = 4 << 20, 1 << 18
#: Counts of a slot, on average.
SLOT_ROWS = 1 << 14

#: The byte of a term, lower-cased, or 0 for all others.
_LETTER = np.zeros(256, np.uint8)
_LETTER[128:] = np.arange(128, 256)
_LETTER[ord("a") : ord("z") + 1] = _LETTER[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def slices(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased buffer, and where the terms begin and end. No term goes on from one text to the next."""
    low = _LETTER[raw]
    solid = low > 0
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before = np.r_[False, solid[:-1]] & ~edge[:-1]
    after = np.r_[solid[1:], False] & ~edge[1:]
    return low, np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1


def grouped(low: np.ndarray, begin: np.ndarray, end: np.ndarray, hashed=xxhash.xxh3_64_intdigest) -> tuple[list[bytes], np.ndarray]:
    """The distinct slices, and for each slice which of them it is. Hashes only propose; bytes decide."""
    n, data = len(begin), low.tobytes()
    hashes = np.empty(n, np.uint64)
    for a in range(0, n, SLICES):
        x, y = begin[a : a + SLICES].tolist(), end[a : a + SLICES].tolist()
        hashes[a : a + SLICES] = [hashed(data[i:j]) for i, j in zip(x, y, strict=True)]
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    size, lead = end - begin, first[which]
    unlike = size != size[lead]
    for a in range(0, n, SLICES):
        some = a + np.flatnonzero(~unlike[a : a + SLICES])
        if len(some):
            run = size[some]
            ends = np.cumsum(run)
            within = np.arange(ends[-1]) - np.repeat(ends - run, run)
            same = low[np.repeat(begin[some], run) + within] == low[np.repeat(begin[lead[some]], run) + within]
            unlike[some] = ~np.logical_and.reduceat(same, ends - run)
    terms = [data[begin[i] : end[i]] for i in first.tolist()]
    more: dict[bytes, int] = {}
    for i in np.flatnonzero(unlike).tolist():
        word = data[begin[i] : end[i]]
        which[i] = more.setdefault(word, len(terms))
        if which[i] == len(terms):
            terms.append(word)
    return terms, which


def counted(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of a term, for each stretch of texts that a task takes at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, offsets in text_chunks(batch.column(0), TEXT_BYTES):
                low, begin, end = slices(raw, offsets)
                if not len(begin):
                    continue
                terms, which = grouped(low, begin, end)
                names = list(zip(*(batch.column(c).slice(a, b - a).to_pylist() for c in (1, 2)), strict=True))
                groups = {name: g for g, name in enumerate(dict.fromkeys(names))}
                of = np.array([groups[name] for name in names])
                # one entry for each document and term, then one for each group and term
                doc = np.searchsorted(offsets, begin, "right") - 1
                places, times = np.unique(doc * len(terms) + which, return_counts=True)
                key = of[places // len(terms)] * len(terms) + places % len(terms)
                order = np.argsort(key, kind="stable")
                key, times = key[order], times[order]
                starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
                n, held, key = np.add.reduceat(times, starts), np.diff(np.r_[starts, len(key)]), key[starts]
                listed = list(groups)
                lang, source = (pa.DictionaryArray.from_arrays(pa.array(key // len(terms), pa.int32()), pa.array([x[c] for x in listed], pa.string())).cast(pa.string()) for c in (0, 1))
                term = pa.array(terms, pa.binary()).take(pa.array(key % len(terms))).cast(pa.string())
                yield pa.RecordBatch.from_arrays([lang, source, term, pa.array(n, pa.int64()), pa.array(held, pa.int64())], ["lang", "source", "term", "n", "docs"])

    texts = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))))
    return texts.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def scaled(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10**9 * (count + 1) / total), by long division in steps of a thousand: exact while total is below 9 * 10**15."""
    rest, out = count + 1, np.zeros(np.broadcast(count, total).shape, np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def slot_sums(term: np.ndarray, source: np.ndarray, n: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Divergences [of, from] over a slot's terms. Entries (term, source, n) of a CSR matrix; totals: N + V of each source."""
    sources, out = len(totals), np.zeros((len(totals), len(totals)), np.int64)
    if not len(term):
        return out
    terms, none = int(term.max()) + 1, scaled(np.zeros(sources, np.int64), totals)
    order = np.lexsort((term, source))
    term, source, p = term[order], source[order], scaled(n[order], totals[source[order]])
    starts = np.searchsorted(source, np.arange(sources + 1))
    there = np.flatnonzero(np.diff(starts))
    for s in range(sources):
        own = np.full(terms, none[s])
        own[term[starts[s] : starts[s + 1]]] = p[starts[s] : starts[s + 1]]
        value, times = np.unique(own, return_counts=True)
        out[s] = (_apart(value[:, None], none[None, :]) * times[:, None]).sum(0)  # as if no other source had any of the terms
        more = _apart(own[term], p) - _apart(own[term], none[source])
        out[s, there] += np.add.reduceat(more, starts[there])
    return out


def best_terms(term: np.ndarray, source: np.ndarray, n: np.ndarray, totals: np.ndarray, lang_total: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(entry, value) of the terms that are likelier in a source than in its language: the best of each source. Terms ascend."""
    starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
    q = scaled(np.add.reduceat(n, starts), np.int64(lang_total))[np.cumsum(np.r_[False, term[1:] != term[:-1]])]
    p = scaled(n, totals[source])
    entry = np.flatnonzero(p > q)
    value = _apart(p[entry], q[entry])
    order = np.lexsort((term[entry], -value, source[entry]))
    entry, value = entry[order], value[order]
    rank = np.arange(len(entry)) - np.searchsorted(source[entry], source[entry])
    return entry[rank < top], value[rank < top]


def _slots(top: int):
    def one(lang: str, heads: list[tuple], rows: list[tuple]) -> pa.RecordBatch:
        names, totals, whole = [h[0] for h in heads], np.array([h[1] for h in heads], np.int64), heads[0][2]
        place = {name: k for k, name in enumerate(names)}
        words = list(dict.fromkeys(r[1] for r in rows))
        at = {w: k for k, w in enumerate(words)}
        term, source, n = (np.array(x, np.int64) for x in ([at[r[1]] for r in rows], [place[r[0]] for r in rows], [r[2] for r in rows]))
        sums = slot_sums(term, source, n, totals)
        found = [(lang, names[s], "pair", names[t], int(sums[s, t])) for s in range(len(names)) for t in range(len(names)) if s != t]
        if rows:
            entry, value = best_terms(term, source, n, totals, whole, top)
            found += [(lang, names[s], "term", words[t], v) for s, t, v in zip(source[entry].tolist(), term[entry].tolist(), value.tolist(), strict=True)]
        columns = list(zip(*found, strict=True)) or [()] * 5
        kinds = [pa.string()] * 4 + [pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lang", "source", "part", "item", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, heads, rows = None, [], []
        for batch in batches:
            for slot, lang, source, term, n, whole in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (slot, lang) != key:
                    if heads:
                        yield one(key[1], heads, rows)
                    key, heads, rows = (slot, lang), [], []
                if term is None:
                    heads.append((source, n, whole))
                else:
                    rows.append((source, term, n))
        if heads:
            yield one(key[1], heads, rows)

    return run


def divergences(docs: DataFrame, least_docs: int = 3, top: int = 200, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): part pair has all other sources of the language, part term the `top` terms of the source."""
    spark, folder = docs.sparkSession, shared_dir(docs.sparkSession, "divergence")
    counts = counted(docs, text_col, lang_col, source_col).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    same = Window.partitionBy("lang", "term")
    first = (F.row_number().over(same.orderBy("source")) == 1).cast("long")
    kept = counts.select("lang", "source", "term", "n", F.sum("docs").over(same).alias("held"), first.alias("first")).where(F.col("held") >= least_docs).drop("held")
    kept = save(kept, f"{folder}/kept")

    groups = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source")))).distinct()
    of_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum("first").alias("v"))
    whole = Window.partitionBy("lang")
    groups = groups.join(of_source, ["lang", "source"], "left").na.fill(0, ["n", "v"])
    groups = groups.select("lang", "source", (F.col("n") + F.sum("v").over(whole)).alias("n"), (F.sum("n").over(whole) + F.sum("v").over(whole)).alias("whole"))

    slots = max(1, -(-kept.count() // SLOT_ROWS))
    heads = groups.select(F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"), "lang", "source", F.lit(None).cast("string").alias("term"), "n", "whole")
    entries = kept.select(F.pmod(F.xxhash64("lang", "term"), F.lit(slots)).cast("int").alias("slot"), "lang", "source", "term", "n", F.lit(None).cast("long").alias("whole"))
    # nulls first: the sources stand in front of the terms
    dealt = entries.unionByName(heads).repartition("slot").sortWithinPartitions("slot", "lang", "term", "source")
    found = save(dealt.mapInArrow(_slots(top), "lang string, source string, part string, item string, value long"), f"{folder}/found")

    # a term is in one slot, so only pairs have several rows to add
    added = found.groupBy("lang", "source", "part", "item").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value"))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = added.withColumn("rank", F.row_number().over(best)).where((F.col("part") == "pair") | (F.col("rank") <= top))
    return ranked.select("lang", "source", "part", "item", "value", "rank")
