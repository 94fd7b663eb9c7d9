"""Best-fit packing of documents into bins of a fixed number of words, under conflicts.

A bin takes at most one document of each source and one of each cluster of duplicates. Bins are ordered by what room is
left and carry bitmaps of their sources and clusters; a document goes to the fullest bin that has room and shares no bit
with it (the search goes on from bin to bin until one is compatible), or to a new bin. Larger documents go first.

Documents are dealt by a hash of their id, size and copy into shards of about SHARD_ROWS rows, each packed by a task of its
own: a shard has the same size at any scale, and no source, cluster or repeated row is gathered in one task. The cost is one
partly filled tail of bins a shard.

Defined results: a text longer than a bin is cut into full bins and a rest that is packed like a document; an empty or
null text gets one row without a bin; a null source or cluster conflicts with nothing; repeated rows are separate copies
(numbered by copy) of one cluster; ties go by id, then copy, and the oldest of equally full bins. Null ids are packed too.
An empty table gives an empty result. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import WORD

SHARD_ROWS = 8192
SCHEMA = "doc_id long, copy int, piece int, bin_id long, bin_offset int, word_start long, words int, source string"


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[int]:
    """The bin of each item, in the given order. sources and clusters are bitmaps (0: no conflict)."""
    room: list[int] = []  # of residuals that some bin has, ascending
    at: dict[int, list[int]] = {}  # bins of a residual, oldest first
    common: dict[int, int] = {}  # sources that all bins of a residual have: none of them can take such a document
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    out = []
    for size, s, c in zip(sizes, sources, clusters, strict=True):
        found, left = -1, capacity
        for k in range(bisect_left(room, size), len(room)):
            r = room[k]
            if common[r] & s:
                continue
            for x in at[r]:
                if not source_bits[x] & s and not cluster_bits[x] & c:
                    found, left = x, r
                    break
            if found >= 0:
                break
        if found < 0:
            found = len(source_bits)
            source_bits.append(0)
            cluster_bits.append(0)
        else:
            at[left].remove(found)
            if not at[left]:
                del at[left], common[left]
                del room[bisect_left(room, left)]
        source_bits[found] |= s
        cluster_bits[found] |= c
        left -= size
        if left > 0:
            if left in at:
                insort(at[left], found)
                common[left] &= source_bits[found]
            else:
                at[left], common[left] = [found], source_bits[found]
                insort(room, left)
        out.append(found)
    return out


def _bits(values: pd.Series) -> list[int]:
    """One bit for each value that occurs twice or more; none for null."""
    codes, _ = pd.factorize(values.where(values.duplicated(keep=False)))
    return [1 << int(c) if c >= 0 else 0 for c in codes]


def _pack_shard(p: pd.DataFrame, capacity: int) -> pd.DataFrame:
    p = p.sort_values(["doc_id", "cluster", "source", "copy"], kind="stable", na_position="last").reset_index(drop=True)
    shard = int(p.shard.iloc[0])
    size = p["size"].to_numpy()
    full = size // capacity
    rest = size - full * capacity
    order = np.lexsort((np.arange(len(p)), -rest))
    order = order[rest[order] > 0]
    sources, clusters = _bits(p.source), _bits(p.cluster)
    bins = best_fit([int(rest[i]) for i in order], [sources[i] for i in order], [clusters[i] for i in order], capacity)
    used: dict[int, int] = {}
    rows = []
    for i, b in zip(order, bins, strict=True):
        rows.append((i, int(full[i]), b, used.get(b, 0), int(full[i]) * capacity, int(rest[i])))
        used[b] = used.get(b, 0) + int(rest[i])
    last = len(used)
    for i in np.flatnonzero(full):
        for k in range(int(full[i])):
            rows.append((i, k, last, 0, k * capacity, capacity))
            last += 1
    for i in np.flatnonzero(size == 0):
        rows.append((i, 0, None, None, 0, 0))
    out = pd.DataFrame(rows, columns=["i", "piece", "bin", "bin_offset", "word_start", "words"])
    i = out.i.to_numpy(int)
    out["doc_id"], out["copy"], out["source"] = p.doc_id.to_numpy()[i], p["copy"].to_numpy()[i], p.source.to_numpy()[i]
    out["bin_id"] = [None if pd.isna(b) else (shard << 32) + int(b) for b in out.bin]
    out["bin_id"], out["bin_offset"], out["doc_id"] = out.bin_id.astype("Int64"), out.bin_offset.astype("Int32"), pd.array(out.doc_id, "Int64")
    return out[["doc_id", "copy", "piece", "bin_id", "bin_offset", "word_start", "words", "source"]]


def packed(docs: DataFrame, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cluster_col: str | None = None) -> DataFrame:
    """One row for each piece of a row of docs: doc_id, copy, piece, bin_id, bin_offset, word_start, words, source.

    cluster_col names the duplicates; without it, rows with the same lower-cased text are duplicates of each other.
    """
    cluster = F.col(cluster_col).cast("string") if cluster_col else F.md5(F.lower(F.col(text_col)))
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    shards = max(1, -(-docs.count() // SHARD_ROWS))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), size.alias("size"), F.col(source_col).cast("string").alias("source"), cluster.alias("cluster"))
    # equal rows are counted before the shuffle and numbered after it, so that their copies can be dealt over all shards
    rows = rows.groupBy("doc_id", "size", "source", "cluster").agg(F.count(F.lit(1)).cast("int").alias("n"))
    rows = rows.select("doc_id", "size", "source", "cluster", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("copy"))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "size", "copy"), F.lit(shards)))
    return rows.groupBy("shard").applyInPandas(lambda p: _pack_shard(p, capacity), SCHEMA)


def bin_texts(pieces: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bin_id, words, doc_ids, text): the pieces of each bin in order, their words joined by spaces. Ids must be unique in docs."""
    words = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.regexp_extract_all(text_col, F.lit(WORD), F.lit(0)).alias("all"))
    parts = pieces.where("bin_id is not null").join(words, "doc_id").withColumn("part", F.array_join(F.expr("slice(all, cast(word_start + 1 as int), words)"), " "))
    bins = parts.groupBy("bin_id").agg(F.array_sort(F.collect_list(F.struct("bin_offset", "doc_id", "part"))).alias("p"), F.sum("words").alias("words"))
    return bins.select("bin_id", "words", F.col("p.doc_id").alias("doc_ids"), F.array_join(F.col("p.part"), "\n").alias("text"))
