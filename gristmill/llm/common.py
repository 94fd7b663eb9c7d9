"""Shared helpers: tables, the shared folder, and vectorised tokenising of Arrow text columns."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the white space that separates words in every contract here.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a task tokenises at a time; a longer text is taken whole.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, n: int) -> Column:
    """crc32 of the id as text, modulo n: the split into training and held-out rows."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def fresh(df: DataFrame, *names: str) -> tuple[str, ...]:
    """Names for helper columns that no column of df has, in whatever case."""
    taken = {c.lower() for c in df.columns}

    def free(name: str) -> str:
        while name in taken:
            name = f"_{name}"
        return name

    return tuple(free(f"_{n}") for n in names)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir. Only a local session without that setting gets a temporary one."""
    top = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = _local_top()
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@lru_cache(maxsize=1)
def _local_top() -> str:
    return tempfile.mkdtemp(prefix="gristmill-")


def posix(path: str) -> str:
    """The plain path of a shared folder that is mounted alike on all machines; memory maps need one."""
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{path} can't be memory-mapped: mount the shared folder and name it as file://")
    return unquote(parts.path)


def save(df: DataFrame, path: str) -> DataFrame:
    """Cut the lineage with a table in the shared folder; it outlives any executor."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


# --- tokens of many texts at once -----------------------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + CHUNK_BYTES // 4)
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            _powers[k] = p
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of a hash depends on every bit of its input."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about limit bytes. A null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b, raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words, A-Z lower-cased, and where each row's words begin among them (n + 1 numbers)."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    solid = ~_SPACE[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:n]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers_to(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[raw]] * up, out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return hashes, np.searchsorted(starts, offsets)
