"""Language-model scoring: interpolated modified Kneser-Ney, counted in Spark, kept as sorted hash arrays.

The order N of the model is a parameter, 2 or more. Its steps:

1. Tasks tokenise whole texts, add up the N-grams of what they read and deal them to shards by the key of the whole
   N-gram. So no context, however frequent, is gathered anywhere: each task sends an N-gram once.
2. A shard adds up its N-grams and writes (keys, counts) sorted by key into the shared folder. What it knows of their
   contexts (counts, continuations seen 1, 2 and more times) and of the (N-1)-grams that they end in (one word more before
   them) is added up by key and passed on.
3. Those sums are dealt by ranges of keys, added up and written as sorted arrays too. Of orders above 1, the counts of words
   before are the lower order's counts: they are passed on in the same way, down to single words.
4. Beyond FILES shards or ranges, tasks join neighbouring ones to FILES sorted arrays an order, so that the number of files doesn't
   grow with the input.
5. Workers map the files into memory and look up the sorted distinct words and n-grams of each run of texts.

Tokens: words (A-Z lower-cased) and one end a text, which counts as a word of the vocabulary; a text's first token follows
N - 1 start marks. All counts are exact over all training rows, nothing is pruned.

Defined results: null text is empty, it has the end alone; a null id has no fold, isn't held out and is learned from;
repeated rows count each; without training rows N and V are 0 and all scores come from the uniform share 1 / (V + 1).
Other columns are ignored. The shared folder must be mounted (a path or file://), as memory maps need files.
"""

from __future__ import annotations

import contextlib
import os
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm.common import fold, mix, posix, save, shared_dir, text_chunks, word_hashes

#: Characters of training text that a shard of N-grams stands for, shards for one range of the lower orders' sums, and
#: bytes of N-grams that a task gathers before it deals them out.
SHARD_CHARS, RANGE_SHARDS, GATHER_BYTES = 18_000_000, 3, 48 << 20
#: Arrays that an order's shards or ranges are joined to, at most.
FILES = 128
START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_LEFT, _RIGHT = np.uint64(0xD1342543DE82EF95), np.uint64(0xA3B195354A39B70D)


def gram_keys(words: Sequence[np.ndarray]) -> np.ndarray:
    """A key of each n-gram from its words' hashes, first word first. The key of one word is its hash."""
    keys = words[0]
    for w in words[1:]:
        keys = keys * _LEFT
        keys += w * _RIGHT
        keys = mix(keys)
    return keys


def grams(hashes: np.ndarray, at: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """All texts' N-grams, as one array for each place in them, the token itself last; and where each text's begin."""
    lengths = np.diff(at) + 1
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    token = np.empty(bounds[-1], np.uint64)
    inner = np.ones(bounds[-1], bool)
    inner[bounds[1:] - 1] = False
    token[inner], token[bounds[1:] - 1] = hashes[at[0] : at[-1]], END
    out = [token]
    for _ in range(order - 1):
        before = np.empty_like(token)
        before[1:] = out[0][:-1]
        before[bounds[:-1]] = START
        out.insert(0, before)
    return out, bounds


def _part(keys: np.ndarray, n: int) -> np.ndarray:
    """Which of n equal ranges of the upper half of a key it is in."""
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int32)


def _firsts(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)


def _pack(x: np.ndarray, cut: np.ndarray, some: list[int]) -> list[bytes]:
    """Pieces of an array of whole numbers, in as few bytes each as the largest needs; that width comes first."""
    kind = np.min_scalar_type(int(x.max())) if len(x) else np.dtype(np.uint8)
    return [bytes([kind.itemsize]) + x[cut[k] : cut[k + 1]].astype(kind).tobytes() for k in some]


def _dealt(train: DataFrame, order: int, shards: int) -> DataFrame:
    """(part, w0, w1, ..., counts) of packed arrays: the N-grams of train, added up by task."""
    names = [f"w{k}" for k in range(order)]

    def deal(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        words = [np.concatenate(x) for x in zip(*held, strict=True)]
        held.clear()  # the joined arrays are all that is needed while they are sorted
        keys = gram_keys(words)
        by_key = np.argsort(keys)
        keys = keys[by_key]
        first = _firsts(keys)
        counts = np.diff(np.r_[first, len(keys)]).astype(np.uint32)
        part, by_key = _part(keys[first], shards), by_key[first]
        del keys
        words = [w[by_key] for w in words]
        del by_key
        # by shard, then by first word: those repeat and pack well
        by_word = np.lexsort((words[0], part))
        words, counts, part = [w[by_word] for w in words], counts[by_word], part[by_word]
        cut = np.searchsorted(part, np.arange(shards + 1))
        some = [k for k in range(shards) if cut[k] < cut[k + 1]]
        columns = [pa.array(_pack(w, cut, some), pa.binary()) for w in words]
        return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *columns, pa.array(_pack(counts, cut, some), pa.binary())], ["part", *names, "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            for _, _, raw, offsets in text_chunks(batch.column(0)):
                words, _ = grams(*word_hashes(raw, offsets), order)
                held.append(words)
                size += sum(w.nbytes for w in words)
                if size >= GATHER_BYTES:
                    yield deal(held)
                    size = 0
        if held:
            yield deal(held)

    return train.select(F.col("text").cast("string")).mapInArrow(run, f"part int, {', '.join(f'{n} binary' for n in names)}, counts binary")


def _joined(p: pd.DataFrame, name: str) -> np.ndarray:
    """A column's packed pieces as one array; the column is given up, so that no shard is held twice."""
    return np.concatenate([np.zeros(0, np.uint8), *[np.frombuffer(x, f"u{x[0]}", offset=1) for x in p.pop(name)]])


def _write(folder: str, name: str, **arrays: np.ndarray) -> None:
    """Each array as a file of its own, under a name of the attempt first: a repeated task leaves the same files."""
    os.makedirs(folder, exist_ok=True)
    attempt = TaskContext.get().taskAttemptId()
    for k, x in arrays.items():
        at = f"{folder}/{name}.{k}.npy"
        with open(f"{at}.{attempt}", "wb") as f:
            np.save(f, x if k == "keys" or not len(x) else x.astype(np.min_scalar_type(int(x.max()))))
        os.replace(f"{at}.{attempt}", at)


#: What is known of an n-gram below the order: occurrences, distinct words before it; and as a context: the sum of the counts
#: of what follows it, and how many of those are 1, 2 and more.
FIELDS = ("count", "before", "total", "once", "twice", "more")
#: Passed on beside them, once a task: for each order how many counts are 1, 2, 3 and 4.
_STATS = "stats"


def _wide(field: str) -> type:
    return np.uint64 if field in ("count", "total") else np.uint32


def _below(words: list[np.ndarray], occurs: np.ndarray, value: np.ndarray, parts: int, stats: np.ndarray) -> pd.DataFrame:
    """Rows for the order below: what distinct n-grams, with their counts value, tell of their contexts and their ends."""
    # contexts first, then ends; each with only those fields that it has
    rows: list[tuple[np.ndarray, list[np.ndarray], dict[str, np.ndarray]]] = []
    one = np.ones(len(value), np.uint32)
    sides = ((words[:-1], {"total": value, "once": value == 1, "twice": value == 2, "more": value > 2}), (words[1:], {"count": occurs, "before": one}))
    for side, fields in sides:
        keys = gram_keys(side)
        order = np.argsort(keys)
        keys = keys[order]
        first = _firsts(keys)
        sums = {f: np.add.reduceat(v[order], first, dtype=_wide(f)) if len(first) else np.zeros(0, _wide(f)) for f, v in fields.items()}
        rows.append((keys[first], [w[order[first]] for w in side], sums))
    keys = np.concatenate([r[0] for r in rows])
    order = np.argsort(keys, kind="stable")
    part = _part(keys[order], parts)
    cut = np.searchsorted(part, np.arange(parts + 1))
    some = [k for k in range(parts) if cut[k] < cut[k + 1]] or [0]
    out: dict[str, list] = {"part": some}
    for k in range(len(words) - 1):
        out[f"w{k}"] = _pack(np.concatenate([r[1][k] for r in rows])[order], cut, some)
    for f in FIELDS:
        out[f] = _pack(np.concatenate([r[2].get(f, np.zeros(len(r[0]), _wide(f))) for r in rows])[order], cut, some)
    out[_STATS] = [stats.tobytes()] + [b""] * (len(some) - 1)
    return pd.DataFrame(out)


def _told(value: np.ndarray) -> list[int]:
    return [int((value == k).sum()) for k in (1, 2, 3, 4)]


def _count_top(p: pd.DataFrame, folder: str, order: int, parts: int) -> pd.DataFrame:
    """Write one shard of N-grams; the rows that it passes on."""
    part = int(p.part.iloc[0])
    words, count = [_joined(p, f"w{k}") for k in range(order)], _joined(p, "counts")
    keys = gram_keys(words)
    by_key = np.argsort(keys)
    keys = keys[by_key]
    first = _firsts(keys)
    count = np.add.reduceat(count[by_key], first, dtype=np.uint64)
    words, keys = [w[by_key[first]] for w in words], keys[first]
    del by_key
    _write(folder, f"{order}-{part:06d}", keys=keys, counts=count)
    del keys
    stats = np.zeros((order, 4), np.int64)
    stats[order - 1] = _told(count)
    return _below(words, count, count, parts, stats)


def _count_lower(p: pd.DataFrame, folder: str, level: int, order: int, parts: int) -> pd.DataFrame:
    """Write one range of n-grams of an order below the top; the rows that it passes on, at single words the sums."""
    part = int(p.part.iloc[0])
    stats = np.frombuffer(b"".join(p.pop(_STATS)), np.int64).reshape(-1, order, 4).sum(0)
    words = [_joined(p, f"w{k}").astype(np.uint64) for k in range(level)]
    keys = gram_keys(words)
    by_key = np.argsort(keys)
    keys = keys[by_key]
    first = _firsts(keys)
    sums = {f: np.add.reduceat(_joined(p, f)[by_key], first, dtype=np.uint64) if len(first) else np.zeros(0, np.uint64) for f in FIELDS}
    words = [w[by_key[first]] for w in words]
    _write(folder, f"{level}-{part:06d}", keys=keys[first], **{f: v for f, v in sums.items() if f != "count" or level == 1})
    stats = stats.copy()
    stats[level - 1] = _told(sums["before"])
    if level > 1:
        seen = sums["before"] > 0  # the others are contexts alone
        return _below([w[seen] for w in words], sums["count"][seen], sums["before"][seen], parts, stats)
    row = {"tokens": int(sums["count"].sum()), "vocabulary": int((sums["count"] > 0).sum()), "pairs": int(sums["before"].sum())}
    return pd.DataFrame([row | {f"n{j}_{k}": int(stats[j, k]) for j in range(order) for k in range(4)}])


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The three discounts of modified Kneser-Ney from how many counts are 1, 2, 3 and 4."""
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
    up = lambda k, a, b: min(max(k - (k + 1) * y * b / a, 0.1), k - 0.1) if a else 0.5
    return up(1, n1, n2), up(2, n2, n3), up(3, n3, n4)


class Model(NamedTuple):
    folder: str
    order: int
    shards: int
    ranges: int
    tokens: int
    vocabulary: int
    pairs: int
    #: The three discounts of each order, single words first, and how many words were seen after 1, 2 and more words.
    off: tuple[tuple[float, float, float], ...]
    ones: tuple[int, int, int]
    #: Shards, and ranges, that one file holds.
    shards_a_file: int = 1
    ranges_a_file: int = 1

    def place(self, level: int) -> tuple[int, int]:
        """Parts of an order, and how many of them a file holds."""
        return (self.shards, self.shards_a_file) if level == self.order else (self.ranges, self.ranges_a_file)


def _join(folder: str, level: int, file: int, parts: range, fields: tuple[str, ...]) -> None:
    """Join the arrays of neighbouring parts to one file a field and then remove them.

    A field's file appears under its name only when it is whole, and parts go only after that; so a repeated task goes on where the
    former one was lost, and one that runs beside another finds the file there.
    """
    for field in fields:
        to = f"{folder}/joined/{level}-{file:06d}.{field}.npy"
        names = [f"{folder}/{level}-{k:06d}.{field}.npy" for k in parts]
        if not os.path.exists(to):
            os.makedirs(f"{folder}/joined", exist_ok=True)
            attempt = f"{to}.{TaskContext.get().taskAttemptId()}"
            try:
                have = [np.load(n, mmap_mode="r") for n in names if os.path.exists(n)]
                kind = max((x.dtype for x in have), key=lambda t: t.itemsize, default=np.dtype(np.uint8))
                out = np.lib.format.open_memmap(attempt, "w+", kind, (sum(map(len, have)),)) if any(map(len, have)) else None
                at = 0
                for x in have:
                    if len(x):
                        out[at : at + len(x)] = x
                    at += len(x)
                if out is None:
                    with open(attempt, "wb") as f:
                        np.save(f, np.zeros(0, kind))
                else:
                    out.flush()
                # parts only go once the file is there, so what was read is whole unless another attempt has made it
                os.remove(attempt) if os.path.exists(to) else os.replace(attempt, to)
            except FileNotFoundError:
                if not os.path.exists(to):
                    raise
        for n in names:
            if os.path.exists(n):
                with contextlib.suppress(FileNotFoundError):
                    os.remove(n)


def _joined_files(spark: SparkSession, folder: str, order: int, shards: int, ranges: int) -> tuple[int, int]:
    """Join what is more than FILES; parts that a file then holds, of the top order and of the lower ones."""
    shards_a_file, ranges_a_file = -(-shards // FILES), -(-ranges // FILES)
    work = [(level, k, n, a) for level in range(1, order + 1) for n, a in [(shards, shards_a_file) if level == order else (ranges, ranges_a_file)] if a > 1 for k in range(-(-n // a))]
    if work:

        def run(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for p in rows:
                for i in p.id:
                    level, k, n, a = work[i]
                    fields = ("keys", "counts") if level == order else ("keys", *(f for f in FIELDS if f != "count" or level == 1))
                    _join(folder, level, k, range(k * a, min((k + 1) * a, n)), fields)
                yield p

        spark.range(0, len(work), 1, len(work)).mapInPandas(run, "id long").agg(F.count("id")).collect()
    return shards_a_file, ranges_a_file


def count(train: DataFrame, order: int = 2, text_col: str = "text") -> Model:
    """Count the model over the rows of train."""
    if order < 2:
        raise ValueError("the order is 2 or more")
    spark, folder = train.sparkSession, shared_dir(train.sparkSession, "lm")
    texts = train.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, -(-size * (order - 1) // SHARD_CHARS))
    ranges = max(1, shards // RANGE_SHARDS)
    place = posix(folder)
    words = lambda n: "part int, " + ", ".join(f"w{k} binary" for k in range(n)) + ", " + ", ".join(f"{f} binary" for f in (*FIELDS, _STATS))
    counted = _dealt(texts, order, shards).groupBy("part").applyInPandas(lambda p: _count_top(p, place, order, ranges), words(order - 1))
    at_level = lambda level: lambda p: _count_lower(p, place, level, order, ranges)
    for level in range(order - 1, 0, -1):
        sums = "tokens long, vocabulary long, pairs long, " + ", ".join(f"n{j}_{k} long" for j in range(order) for k in range(4))
        counted = counted.groupBy("part").applyInPandas(at_level(level), words(level - 1) if level > 1 else sums)
    done = save(counted, f"{folder}/sums")
    r = done.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in done.columns]).first()
    off = tuple(discounts(*(r[f"n{j}_{k}"] for k in range(4))) for j in range(order))
    held = _joined_files(spark, place, order, shards, ranges)
    return Model(place, order, shards, ranges, r.tokens, r.vocabulary, r.pairs, off, (r.n0_0, r.n0_1, r.vocabulary - r.n0_0 - r.n0_1), *held)


class Mapped:
    """The model's arrays, mapped into memory when they are first looked at: at most FILES of each field of an order."""

    def __init__(self, model: Model):
        self.m, self.files = model, {}

    def array(self, level: int, file: int, field: str) -> np.ndarray | None:
        key = (level, file, field)
        if key not in self.files:
            folder = self.m.folder if self.m.place(level)[1] == 1 else f"{self.m.folder}/joined"
            at = f"{folder}/{level}-{file:06d}.{field}.npy"
            self.files[key] = np.load(at, mmap_mode="r") if os.path.exists(at) else None
        return self.files[key]

    def find(self, level: int, keys: np.ndarray, fields: tuple[str, ...]) -> list[np.ndarray]:
        """Fields of the n-grams of one order with these ascending keys; 0 where there is none."""
        n, a_file = self.m.place(level)
        out = [np.zeros(len(keys), np.int64) for _ in fields]
        cut = np.searchsorted(_part(keys, n) // a_file, np.arange(-(-n // a_file) + 1))
        for k in np.flatnonzero(np.diff(cut)).tolist():
            own = keys[cut[k] : cut[k + 1]]
            have = self.array(level, k, "keys")
            if have is None or not len(have):
                continue
            place = np.searchsorted(have, own)
            hit = place < len(have)
            hit[hit] = have[place[hit]] == own[hit]
            for o, f in zip(out, fields, strict=True):
                o[cut[k] : cut[k + 1]][hit] = self.array(level, k, f)[place[hit]]
        return out

    def low(self, before: np.ndarray) -> np.ndarray:
        """The lowest order: discounted shares of distinct words before, with what was taken off spread evenly."""
        d, m = self.m.off[0], self.m
        if not m.pairs:
            return np.full(len(before), 1 / (m.vocabulary + 1))
        off = np.array([0.0, *d])[np.minimum(before, 3)]
        spare = (d[0] * m.ones[0] + d[1] * m.ones[1] + d[2] * m.ones[2]) / m.pairs
        return np.maximum(before - off, 0) / m.pairs + spare / (m.vocabulary + 1)

    def score(self, hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """n_tokens, n_known, base_score and score of each text of a run."""
        m = self.m
        words, bounds = grams(hashes, at, m.order)
        distinct, back = np.unique(words[-1], return_inverse=True)
        seen, before = self.find(1, distinct, ("count", "before"))
        known, base = (seen > 0)[back], np.log10((seen + 0.1) / (m.tokens + 0.1 * (m.vocabulary + 1)))[back]
        p = self.low(before)[back]
        for level in range(2, m.order + 1):
            context, of_context = np.unique(gram_keys(words[-level:-1]), return_inverse=True)
            total, n1, n2, n3 = self.find(level - 1, context, ("total", "once", "twice", "more"))
            d = m.off[level - 1]
            spare = np.where(total > 0, (d[0] * n1 + d[1] * n2 + d[2] * n3) / np.maximum(total, 1), 1.0)
            key, of_key = np.unique(gram_keys(words[-level:]), return_inverse=True)
            (value,) = self.find(level, key, ("counts" if level == m.order else "before",))
            taken = np.maximum(value - np.array([0.0, *d])[np.minimum(value, 3)], 0)
            p = taken[of_key] / np.maximum(total, 1)[of_context] + spare[of_context] * p
        add = lambda x: np.add.reduceat(x, bounds[:-1]) if len(bounds) > 1 else np.zeros(0)
        return np.diff(bounds), add(known.astype(np.int64)), add(base), add(np.log10(p))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapped = Mapped(model)
        for batch in batches:
            for a, b, raw, offsets in text_chunks(batch.column(1), 4 << 20):
                n, known, base, score = mapped.score(*word_hashes(raw, offsets))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double")


def perplexity(scores: DataFrame) -> DataFrame:
    """scores with the perplexity of each text, its end included."""
    return scores.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def report(docs: DataFrame, order: int = 2, folds: int = 10, held: int = 0) -> DataFrame:
    held_out = F.coalesce(fold("doc_id", folds) == held, F.lit(False))
    model = count(docs.where(~held_out), order)
    return scored(docs, model).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
