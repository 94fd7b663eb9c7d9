"""MinHash near-duplicates by SetSketch registers.

A document's set holds its distinct shingles of k words (A-Z lower-cased, split at ASCII white space); with fewer
words, the whole sequence is its one shingle. Each of m registers keeps the smallest of exponential hash values,
truncated to an exponentially spaced scale (base b): such registers merge by maxima and are equal with a probability
close to the Jaccard similarity. The steps:

1. One pass over the texts gives each row its sequence digest, set size and registers. Rows of one digest form a class.
2. Bands of registers deal the classes into buckets. The leader of a bucket is its smallest digest, so the buckets of a
   group of near copies elect the same few leaders. Every member is paired once, with the smallest of its leaders.
3. Pairs pass if their joint likelihood (register comparisons given both set sizes) doesn't rule the threshold out.
4. Full sets, hashed to 64 bits, confirm pairs exactly: 100 * shared >= percent * union.
5. Members that aren't connected with a leader of some bucket of theirs yet are compared with that leader in the same way.
6. Buckets whose other members aren't all connected yet are compared block by block, members of unlike components only,
   so that no link hides behind a leader. First the registers tell which members have a plausible partner; then, with
   the full sets of those, each block gives the links that join components, never more than it has members.

Defined results: null text counts as empty; an empty or blank text has an empty set and links with nothing; a row whose
id is null takes no part (component_id null, kept true); rows that repeat an id with the same text share a class, so
all of them are returned alike. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.llm.common import discard, fresh, mix, save, shared_dir, text_chunks, word_hashes
from gristmill.llm.components import components

#: Registers of a band; the probability that a pair at the threshold meets in no band; SetSketch base, rate and top.
BAND = 5
MISS = 1e-6
SKETCH_BASE, SKETCH_RATE, SKETCH_TOP = 1.001, 20.0, 65534
#: A pair stays a candidate unless its likelihood ratio against the threshold passes this many squared sigmas; at 5 a pair at
#: the threshold is given up less often than MISS.
SIGMAS = 5.0
#: Members of a bucket that are compared at once with as many others.
BLOCK = 2048


def bands_for(percent: int) -> int:
    hit = (percent / 100) ** BAND
    return math.ceil(math.log(MISS) / math.log(1 - hit)) if hit < 1 else 1


def shingle_sets(hashes: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, one after the other, and where each row's begin."""
    steps = np.random.default_rng(k).integers(1, 2**63, max(k, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    n = len(hashes)
    rolled = np.zeros(max(n - k + 1, 0), np.uint64)
    for j in range(k):
        rolled += hashes[j : n - k + 1 + j] * steps[j]
    rolled = mix(rolled)
    out, begin = [], [0]
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= k:
            s = np.sort(rolled[a : b - k + 1])
            s = s[np.r_[True, s[1:] != s[:-1]]]
        elif b > a:
            s = mix((hashes[a:b] * steps[: b - a]).sum(keepdims=True) + np.uint64(b - a))
        else:
            s = rolled[:0]
        out.append(s)
        begin.append(begin[-1] + len(s))
    return (np.concatenate(out) if out else rolled[:0]), np.array(begin)


def registers(sets: np.ndarray, begin: np.ndarray, m: int) -> np.ndarray:
    """SetSketch registers of each row (rows x m, uint16). Rows with an empty set get zeros."""
    rng = np.random.default_rng(2021)
    odd = rng.integers(1, 2**63, m, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 2**63, m, dtype=np.uint64) * np.uint64(2)
    n = len(begin) - 1
    low = np.full((n, m), np.uint64(2**64 - 1))
    full = np.flatnonzero(np.diff(begin))
    if len(full):
        starts = begin[full]
        buffer = np.empty_like(sets)
        for j in range(m):
            np.multiply(sets, odd[j], out=buffer)
            buffer += add[j]
            low[full, j] = np.minimum.reduceat(buffer, starts)
    uniform = (low.astype(np.float64) + 0.5) / 2.0**64
    least = -np.log1p(-np.minimum(uniform, 1 - 1e-16)) / SKETCH_RATE
    level = np.floor(1 - np.log(least) / math.log(SKETCH_BASE)) + 32768  # shifted: sets of one element have levels below 0
    out = np.clip(level, 0, SKETCH_TOP + 1).astype(np.uint16)
    out[np.diff(begin) == 0] = 0
    return out


def _p(x: np.ndarray) -> np.ndarray:
    b = SKETCH_BASE
    return -np.log1p(-x * (b - 1) / b) / math.log(b)


def plausible(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs may reach the threshold: joint likelihood of J from how often one register is above the other."""
    up, down = (ra > rb).sum(-1), (ra < rb).sum(-1)
    same = ra.shape[-1] - up - down
    na, nb = na.astype(float), nb.astype(float)
    u, v = na / (na + nb), nb / (na + nb)
    t = percent / 100

    def loglik(j: np.ndarray) -> np.ndarray:
        pu, pd_ = _p(np.maximum(u - v * j, 1e-12)), _p(np.maximum(v - u * j, 1e-12))
        return up * np.log(np.maximum(pu, 1e-12)) + down * np.log(np.maximum(pd_, 1e-12)) + same * np.log(np.maximum(1 - pu - pd_, 1e-12))

    lo, hi = np.zeros_like(u), np.minimum(u / v, v / u)
    possible = hi >= t - 1e-9  # sizes alone can rule a pair out
    top = hi.copy()
    for _ in range(40):
        third = (hi - lo) / 3
        left = loglik(lo + third) >= loglik(hi - third)
        hi, lo = np.where(left, hi - third, hi), np.where(left, lo, lo + third)
    best = (lo + hi) / 2
    return possible & ((best >= t) | (2 * (loglik(best) - loglik(np.minimum(t, top))) <= SIGMAS**2))


def sketches(docs: DataFrame, k: int, m: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, mark, digest, n, regs) of each row: mark is a hash of the text by Spark, digest one of the word sequence."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("mark", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("regs", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, offsets in text_chunks(batch.column(2)):
                hashes, at = word_hashes(raw, offsets)
                sets, begin = shingle_sets(hashes, at, k)
                regs = registers(sets, begin, m)
                digests = [hashlib.blake2b(hashes[x:y].tobytes(), digest_size=16).digest() for x, y in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(digests, pa.binary()), pa.array(np.diff(begin), pa.int64()), pa.array([r.tobytes() for r in regs], pa.binary())], ["doc_id", "mark", "digest", "n", "regs"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def _regs(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(len(column), -1)


def likely(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose registers leave the threshold plausible."""
    side = lambda x: reps.select(F.col("digest").alias(x), F.col("n").alias(f"n_{x}"), F.col("regs").alias(f"r_{x}"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            if len(p):
                yield p.loc[plausible(_regs(p.r_a), _regs(p.r_b), p.n_a.to_numpy(), p.n_b.to_numpy(), percent), ["a", "b"]]

    sizes = (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent) & (F.col("n_a") > 0)
    return pairs.join(side("a"), "a").join(side("b"), "b").where(sizes).mapInPandas(run, "a binary, b binary")


def full_sets(wanted: DataFrame, docs: DataFrame, reps: DataFrame, k: int, id_col: str, text_col: str, folder: str) -> DataFrame:
    """(digest, set) of the classes wanted. Sets are computed again, from one row of each, and written.

    The merge join is asked for, as what is wanted grows with the input: the plan is the same at any size.
    """
    wanted = save(wanted.join(reps.select("digest", "doc_id", "mark"), "digest"), f"{folder}-wanted")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).cast("string").alias("text"))
    texts = texts.join(wanted.hint("merge"), ["doc_id", "mark"]).groupBy("doc_id", "mark").agg(F.min("digest").alias("digest"), F.first("text").alias("text")).select("digest", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, offsets in text_chunks(batch.column(1)):
                sets, begin = shingle_sets(*word_hashes(raw, offsets), k)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([sets[x:y].tobytes() for x, y in zip(begin[:-1], begin[1:], strict=True)], pa.binary())], ["digest", "set"])

    return save(texts.mapInArrow(run, "digest binary, set binary"), f"{folder}-sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets meet the threshold."""

    def check(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            keep = [bool(linked(np.frombuffer(x, np.uint64), [np.frombuffer(y, np.uint64)], percent)[0]) for x, y in zip(p.s_a, p.s_b, strict=True)]
            yield p.loc[np.array(keep, bool), ["a", "b"]]

    side = lambda x: sets.select(F.col("digest").alias(x), F.col("set").alias(f"s_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(check, "a binary, b binary")


def linked(one: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the sorted sets, none empty, meet the threshold with the first."""
    size = np.array([len(x) for x in others])
    flat = np.concatenate(others)
    place = np.searchsorted(one, flat)
    place[place == len(one)] = 0
    shared = np.add.reduceat((one[place] == flat).astype(np.int64), np.r_[0, np.cumsum(size)[:-1]])
    return 100 * shared >= percent * (len(one) + size - shared)


def _bucket_rows(reps: DataFrame, bands: int) -> DataFrame:
    """(bucket, digest, n): a class in each of its bands."""
    width = 2 * BAND
    keys = F.expr(f"transform(sequence(0, {bands - 1}), i -> xxhash64(i, substring(regs, i * {width} + 1, {width})))")
    return reps.where("n > 0").select("digest", "n", F.posexplode(keys).alias("band", "key")).select(F.xxhash64("band", "key").alias("bucket"), "band", "digest", "n")


def _partners(i: int, p: pd.DataFrame, regs: np.ndarray, n: np.ndarray, root: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Rows of right that may link member i to another component, likeliest first, but for pairs that are compared elsewhere."""
    band, m = int(p.band.iloc[0]), regs.shape[1]
    t = percent / 100
    js = right[(root[right] != root[i]) & (np.minimum(n[right], n[i]) * 100 >= np.maximum(n[right], n[i]) * percent)]
    same = regs[js] == regs[i]
    agree = same.sum(1)
    # so many equal registers at least, if the similarity is t; then the joint likelihood decides
    some = agree >= m * t - SIGMAS * math.sqrt(m * t * (1 - t))
    if band:  # pairs that meet in an earlier band are compared there
        some &= ~same[:, : band * BAND].reshape(len(js), band, BAND).all(-1).any(-1)
    js, agree = js[some], agree[some]
    if len(js):
        good = plausible(regs[js], regs[i][None, :], n[js], np.full(len(js), n[i]), percent)
        js = js[good][np.argsort(-agree[good], kind="stable")]
    return js


def _tiles(buckets: DataFrame, roots: DataFrame, reps: DataFrame) -> DataFrame:
    """Members of open buckets, without their leaders, once for each pair of blocks that their own block is part of."""
    placed = buckets.where("digest <> leader").join(roots.select(F.col("node").alias("digest"), "root"), "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    open_ = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo <> hi").select("bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    members = placed.select("bucket", "band", "digest", "n", "root").join(open_, "bucket").join(reps.select("digest", "regs"), "digest").withColumn("own", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
    return members.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select("bucket", "band", F.least("own", "other").alias("row"), F.greatest("own", "other").alias("col"), "own", "digest", "root", "n", "regs")


def _sides(p: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, bool]:
    row, col, own = int(p["row"].iloc[0]), int(p["col"].iloc[0]), p.own.to_numpy()
    return np.flatnonzero(own == row), np.flatnonzero(own == col), row == col


def _hopeful(tiles: DataFrame, percent: int) -> DataFrame:
    """(digest) of the members that have a plausible partner."""

    def run(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        regs, n, (left, right, alone) = _regs(p.regs), p.n.to_numpy(), _sides(p)
        root, _ = pd.factorize(p.root)
        hope = np.zeros(len(p), bool)
        for i in left:
            js = _partners(i, p, regs, n, root, right[right > i] if alone else right, percent)
            hope[js] = True
            hope[i] |= len(js) > 0
        return p.loc[hope, ["digest"]]

    return tiles.groupBy("bucket", "row", "col").applyInPandas(run, "digest binary").distinct()


def _missing_links(tiles: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that join components which a tile holds."""

    def run(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        regs, n, (left, right, alone) = _regs(p.regs), p.n.to_numpy(), _sides(p)
        root, _ = pd.factorize(p.root)
        sets_ = [np.frombuffer(x, np.uint64) for x in p["set"]]
        found = []
        for i in left:
            js = _partners(i, p, regs, n, root, right[right > i] if alone else right, percent)
            while len(js):
                some, js = js[:64], js[64:]
                for j in some[linked(sets_[i], [sets_[j] for j in some], percent)]:
                    if root[j] != root[i]:
                        found.append((p.digest.iloc[i], p.digest.iloc[j]))
                        root[root == root[j]] = root[i]
                js = js[root[js] != root[i]]
        return pd.DataFrame(found, columns=["a", "b"])

    return tiles.join(sets, "digest").groupBy("bucket", "row", "col").applyInPandas(run, "a binary, b binary")


def _starred(pairs: DataFrame, docs: DataFrame, reps: DataFrame, shingle: int, percent: int, id_col: str, text_col: str, folder: str) -> DataFrame:
    """The confirmed of pairs (a, b), written."""
    pairs = save(likely(pairs, reps, percent), f"{folder}/pairs")
    sets = full_sets(pairs.select(F.explode(F.array("a", "b")).alias("digest")).distinct(), docs, reps, shingle, id_col, text_col, f"{folder}/full")
    return save(confirmed(pairs, sets, percent), f"{folder}/links")


def _classes(docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """rows (doc_id, mark, digest, n) of docs, and the classes linked (digest, doc_id, mark, root): root names the component."""
    spark, folder = docs.sparkSession, shared_dir(docs.sparkSession, "near")
    bands, work = bands_for(percent), f"{folder}/work"
    rows = save(sketches(docs, shingle, bands * BAND, id_col, text_col), f"{folder}/rows")
    named = rows.where("doc_id is not null")
    reps = save(named.where("n > 0").groupBy("digest").agg(F.min(F.struct("doc_id", "mark", "n", "regs")).alias("r")).select("digest", "r.*"), f"{work}/reps")

    buckets = _bucket_rows(reps, bands)
    lead = buckets.groupBy("bucket").agg(F.min("digest").alias("leader"), F.count(F.lit(1)).alias("size")).where("size > 1").select("bucket", "leader")
    buckets = save(buckets.join(lead, "bucket"), f"{work}/buckets")
    once = buckets.groupBy(F.col("digest").alias("b")).agg(F.min("leader").alias("a")).where("a < b").select("a", "b")
    star = lambda pairs, at: _starred(pairs, docs, reps, shingle, percent, id_col, text_col, f"{work}/{at}")
    links = star(once, "1")
    roots = components(links, f"{work}/1/cc")

    # leaders that a member isn't connected with: a distinct pair each, but for those that were compared
    of = lambda x: roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}"))
    apart = buckets.where("digest <> leader").select(F.col("leader").alias("a"), F.col("digest").alias("b")).join(of("a"), "a", "left").join(of("b"), "b", "left")
    apart = apart.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b").distinct()
    more = star(apart.join(once, ["a", "b"], "left_anti"), "2")
    if not more.isEmpty():
        links = save(links.union(more), f"{work}/2/all")
        roots = components(links, f"{work}/2/cc")

    tiles = _tiles(buckets, roots, reps)
    hope = save(_hopeful(tiles, percent), f"{work}/hope")
    if not hope.isEmpty():
        sets = full_sets(hope, docs, reps, shingle, id_col, text_col, f"{work}/3")
        more = save(_missing_links(tiles, sets, percent), f"{work}/3/links")
        if not more.isEmpty():
            roots = components(links.union(more), f"{work}/3/cc")

    ids = reps.select("digest", "doc_id", "mark").join(roots.select(F.col("node").alias("digest"), "root"), "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    ids = save(ids, f"{folder}/classes")
    discard(spark, work)
    return rows.select("doc_id", "mark", "digest", "n"), ids


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of docs; component_id is the smallest id reachable by links."""
    rows, ids = _classes(docs, shingle, percent, id_col, text_col)
    least = ids.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_class = ids.join(least, "root").select("digest", "component_id")
    joined = rows.select("doc_id", "digest", F.col("n").alias("n_shingles")).join(of_class, "digest", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs of which one stays for each component: the one with the smallest id. Texts stay as they were.

    Rows are told apart by id and text, so unlike texts under one id all stay; of rows that repeat both, the first by the
    JSON of all their columns does. Rows without an id stay.
    """
    rows, ids = _classes(docs, shingle, percent, id_col, text_col)
    first = ids.groupBy("root").agg(F.min(F.struct("doc_id", "mark")).alias("r"))
    blank = rows.where("n = 0 and doc_id is not null").select("doc_id", "mark").distinct()
    kept = first.select("r.doc_id", "r.mark").union(blank)
    key, mark, row = fresh(docs, "key", "mark", "row")
    keyed = docs.withColumn(key, F.col(f"`{id_col}`").cast("long")).withColumn(mark, F.xxhash64(f"`{text_col}`"))
    stay = keyed.join(kept.select(F.col("doc_id").alias(key), F.col("mark").alias(mark)), [key, mark], "left_semi")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    stay = stay.groupBy(key, mark).agg(F.min_by(whole, F.to_json(whole)).alias(row)).select(f"{row}.*")
    return stay.unionByName(docs.where(F.col(f"`{id_col}`").isNull()))
