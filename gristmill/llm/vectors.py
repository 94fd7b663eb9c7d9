"""Searches of a query set against all vectors, in blocks.

Vectors are dealt by a hash of their id into blocks, queries into blocks of their own; each pair of blocks is one task with
bounded memory, and the best of each block are merged. Both searches share this frame:

* exact_topk: largest inner products of integer vectors, by bounds from means and deviations of segments, coarse to fine;
* nearest: smallest Euclidean distances, by counting collisions of single projections in windows that grow around the query.

Defined results for both: a vector that is null, empty or holds null or non-finite components takes no part (for nearest a
zero vector neither), nor does one whose id is null; a query meets only vectors of its own length; rows with a query's own
id aren't its candidates; rows that repeat an id each count as candidates, and of rows that repeat a query's id, the one with
the smallest vector asks. With fewer candidates than k all are returned; an empty table gives an empty result. Other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK, QUERY_BLOCK = 16_384, 2_048


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def _sorted(p: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a block, by id, then vector."""
    ids, x = p.vec_id.to_numpy(np.int64), np.stack(p.v.to_numpy()).astype(np.float64)
    order = np.lexsort((*x.T[::-1], ids))
    return ids[order], x[order]


def _blockwise(vectors: DataFrame, every: int, k: int, best: Callable, kind: str, largest: bool, id_col: str, vector_col: str) -> DataFrame:
    """best(ids, x, query) -> (ids, scores) of a block; the k best of all blocks are returned."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    v = v.where(F.col("vec_id").isNotNull() & usable(F.col("v"))).withColumn("dim", F.size("v"))
    q = v.where(F.col("vec_id") % every == 0)
    total, asked = v.count(), q.count()
    blocks, query_blocks = max(1, -(-total // BLOCK)), max(1, -(-asked // QUERY_BLOCK))
    deal = lambda df, n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = v.withColumn("b", deal(v, blocks, 1)).withColumn("c", each(query_blocks))
    asks = q.withColumn("c", deal(q, query_blocks, 2)).withColumn("b", each(blocks))

    def run(queries: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(p):
            ids, x = _sorted(p)
            qids, qx = _sorted(queries)
            first = np.r_[True, qids[1:] != qids[:-1]]
            search = best(ids, x)
            for own, y in zip(qids[first], qx[first], strict=True):
                found, scores = search(own, y)
                out.append(pd.DataFrame({"query_id": own, "vec_id": found, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    found = asks.groupBy("dim", "b", "c").cogroup(rows.groupBy("dim", "b", "c")).applyInPandas(run, f"query_id long, vec_id long, score {kind}")
    order = W.partitionBy("query_id").orderBy(F.desc("score") if largest else F.asc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


# --- exact inner products -------------------------------------------------------------------------------------

#: Segments of a vector, coarse to fine; the finest still has two components a segment.
LEVELS = (4, 16, 32)


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments of each row, weighted so that a product of rows bounds the inner product.

    Within a segment of n components, sum(x * y) <= n * (mean x * mean y + deviation x * deviation y); equivalently
    n * ((mean x - mean y)^2 + (deviation x - deviation y)^2) is a lower bound of the squared distance.
    """
    cuts = np.linspace(0, x.shape[1], segments + 1).astype(int)[:-1]
    size = np.diff(np.r_[cuts, x.shape[1]]).astype(float)
    mean = np.add.reduceat(x, cuts, axis=1) / size
    square = np.add.reduceat(x * x, cuts, axis=1) / size
    return np.hstack([mean * np.sqrt(size), np.sqrt(np.maximum(square - mean * mean, 0)) * np.sqrt(size)])


def _exact_search(k: int) -> Callable:
    def prepare(ids: np.ndarray, x: np.ndarray) -> Callable:
        x = np.floor(256 * x)
        dim, top = x.shape[1], float(np.abs(x).max(initial=0))
        levels = [s for s in LEVELS if 2 * s <= dim] or [1]
        stats = [segment_statistics(x, s) for s in levels]
        wide = dim * top * top >= 2.0**53

        def exact(at: np.ndarray, y: np.ndarray) -> np.ndarray:
            if wide or float(np.abs(y).max()) * top * dim >= 2.0**53:  # whole numbers of any size, held to the range of a long
                z = [sum(int(a) * int(b) for a, b in zip(x[i], y, strict=True)) for i in at]
                return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in z], np.int64)
            if 2 * len(at) > len(x):  # one product with the whole block costs less than to gather most of it
                return np.rint(x @ y)[at].astype(np.int64)
            return np.rint(x[at] @ y).astype(np.int64)

        def search(own: int, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            y = np.floor(256 * y)
            at = np.flatnonzero(ids != own)
            if len(at) > k:
                bound = stats[0][at] @ segment_statistics(y[None], levels[0])[0]
                probe = at[np.argpartition(-bound, min(4 * k, len(at) - 1))[: 4 * k]]
                least = float(np.sort(exact(probe, y))[-k])  # k candidates reach it, so nothing below it counts
                slack = 1e-9 * float(np.sqrt((x * x).sum(1).max() * (y * y).sum())) + 1e-6
                at = at[bound >= least - slack]
                for s, m in zip(levels[1:], stats[1:], strict=True):
                    if len(at) <= 4 * k or 2 * len(at) > len(x):  # few are left, or bounds tell these vectors too little to pay for themselves
                        break
                    at = at[m[at] @ segment_statistics(y[None], s)[0] >= least - slack]
            scores = exact(at, y)
            order = np.lexsort((ids[at], -scores))[:k]
            return ids[at][order], scores[order]

        return search

    return prepare


def exact_topk(vectors: DataFrame, every: int = 50, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of floor(256 * x), ties to smaller ids."""
    return _blockwise(vectors, every, k, _exact_search(k), "long", True, id_col, vector_col)


# --- approximate nearest neighbours ---------------------------------------------------------------------------

#: Projections; half-width of the last window in units of the k-th distance; chance that a neighbour at that distance
#: reaches the collision threshold; growth of a window; times k vectors that a step may bring before k are found.
PROJECTIONS, REACH, CATCH, GROWTH, MANY = 160, 1.0, 0.93, 1.6, 4


def _collision_search(k: int) -> Callable:
    meet = NormalDist().cdf(REACH) * 2 - 1  # chance that one projection of a vector at the k-th distance is in the last window
    enough = int(PROJECTIONS * meet - NormalDist().inv_cdf(CATCH) * np.sqrt(PROJECTIONS * meet * (1 - meet)))

    def prepare(ids: np.ndarray, x: np.ndarray) -> Callable:
        n, dim = x.shape
        axes = np.random.default_rng(dim).standard_normal((dim, PROJECTIONS))
        line = (x @ axes).T
        order = np.argsort(line, axis=1, kind="stable")  # one sorted array a projection, one after the other
        line = np.take_along_axis(line, order, 1)
        first = 0.05 * float(np.median(line.std(1))) + 1e-12
        order, lengths, squares = order.ravel(), np.full(PROJECTIONS, n), (x * x).sum(1)
        # the arrays lie side by side on one scale, so that one search finds a window's end on all of them
        reach = float(np.abs(line).max(initial=0)) + 1.0
        shift = np.arange(PROJECTIONS) * 4 * reach
        line = (line + shift[:, None]).ravel()
        begin = np.arange(PROJECTIONS) * n

        def ends(at: np.ndarray, side: str) -> np.ndarray:
            return np.clip(np.searchsorted(line, np.clip(at, -2 * reach, 2 * reach) + shift, side), begin, begin + lengths)

        def search(own: int, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            centre = y @ axes
            met = np.zeros(n, np.int64)
            met[ids == own] = -2 * PROJECTIONS  # never enough
            lo = hi = ends(centre, "left")
            seen, far, near = np.zeros(n, bool), np.full(n, np.inf), float(y @ y)
            left, half, found, before = int((ids != own).sum()), first, 0, 0.0
            while left:
                a, b = np.minimum(ends(centre - half, "left"), lo), np.maximum(ends(centre + half, "right"), hi)
                ring = [order[s:t] for s, t in zip(a.tolist(), lo.tolist(), strict=True) if s < t] + [order[s:t] for s, t in zip(hi.tolist(), b.tolist(), strict=True) if s < t]
                more = met + np.bincount(np.concatenate(ring), minlength=n) if ring else met
                fresh = np.flatnonzero((more >= enough) & ~seen)
                if found < k and found + len(fresh) > MANY * k and half > before * 1.01:
                    half = np.sqrt(max(before, half / GROWTH**2) * half)  # too far at once: step back, nothing is verified yet
                    continue
                met, lo, hi, before = more, a, b, half
                if len(fresh):
                    seen[fresh] = True
                    far[fresh] = np.sqrt(np.maximum(np.nan_to_num(squares[fresh] + near - 2 * (x[fresh] @ y), nan=np.inf), 0))
                    left, found = left - len(fresh), found + len(fresh)
                if found >= k:
                    last = REACH * float(np.partition(far, k - 1)[k - 1])
                    if half >= last:
                        break
                    half = min(half * GROWTH, max(last, half * 1.01))
                else:
                    half *= GROWTH
            at = np.flatnonzero(seen)
            search.verified = len(at)  # for tests: distances that were computed
            if len(at) > k:  # what rounding of the quick distance may let in stays for the exact one
                at = at[far[at] <= np.partition(far[at], k - 1)[k - 1] * (1 + 1e-6) + 1e-6 * np.sqrt(near + 1e-300)]
            exact = np.sqrt(((x[at] - y) ** 2).sum(1))
            best = np.lexsort((ids[at], exact))[:k]
            return ids[at[best]], exact[best]

        return search

    return prepare


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found, nearest first, ties to smaller ids; zero vectors take no part."""
    some = vectors.where(F.exists(vector_col, lambda x: x != 0))
    return _blockwise(some, every, k, _collision_search(k), "double", False, id_col, vector_col)
