"""Approximate nearest neighbours by collision counting over single-projection sorted arrays.

Vectors are dealt into shards by a hash of their id.  A shard's index is a set of
lines, random rotations of the axes; for each line the shard's projections are kept as a
sorted array.  For a query every array is entered at the query's own projection and
a window around it grows round by round (virtual rehashing: the half-width is
multiplied, nothing is hashed again).  A vector collides on a line while it lies in
that line's window; those that collide on ``SHARE`` of the lines are verified by their
exact distance.

When to stop follows from the lines alone, whatever the data or the shard's size: a vector at
distance D reaches the threshold once the half-width is r D, where r depends on its
direction and is at most ``reach`` for the share ``SURE`` of all directions.  The windows grow
until their half-width is ``reach`` times the k-th best distance verified, so each nearer
vector has been verified with that probability.

Queries come in blocks, since a task's memory must not grow with the table: each block
meets each shard in one task, which builds the shard's index once.  A vector is copied, and
its shard's index built, once for every ``BLOCK`` queries, which is next to nothing beside
the search of that many.  Equal vectors of a shard are indexed once and expand to
their smallest ids.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import store

#: Vectors of a shard and queries of a block, about; queries that a task searches side by side.
SHARD, BLOCK, BATCH = 32_768, 16_384, 32
#: Lines; the share of them on which a candidate collides; growth of the windows.
LINES, SHARE, GROW = 192, 0.8, 1.15
#: Share of directions whose vectors are verified in time.
SURE = 0.9


@cache
def lines(width: int, number: int = LINES, seed: int = 11) -> tuple[np.ndarray, float]:
    """``number`` unit vectors as columns, in groups at right angles to one another, and their reach."""
    rng = np.random.default_rng([seed, width])
    turned = [np.linalg.qr(rng.standard_normal((width, width)))[0] for _ in range(-(-number // width))]
    basis = np.concatenate(turned, axis=1)[:, :number]
    some = rng.standard_normal((4096, width))
    apart = np.abs(some / np.linalg.norm(some, axis=1, keepdims=True) @ basis)
    need = math.ceil(SHARE * number)
    return basis, float(np.quantile(np.partition(apart, need - 1, axis=1)[:, need - 1], SURE))


class Shard:
    """The index of a shard's different vectors."""

    def __init__(self, vectors: np.ndarray, number: int = LINES):
        self.vectors = vectors
        self.basis, self.reach = lines(vectors.shape[1], number)
        self.need = math.ceil(SHARE * number)
        self.order = np.empty((number, len(vectors)), np.int32)
        self.sorted = np.empty((number, len(vectors)))
        for i in range(number):
            projected = vectors @ self.basis[:, i]
            self.order[i] = np.argsort(projected, kind="stable")
            self.sorted[i] = projected[self.order[i]]
        spread = np.quantile(self.sorted, [0.45, 0.55], axis=1)
        self.start = max(float(np.median(spread[1] - spread[0])) / 2, 1e-12)

    def search(self, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (places, distances) of the vectors verified, unordered; ``k`` at least if there are as many."""
        n, m, number = len(self.vectors), len(queries), len(self.sorted)
        at = queries @ self.basis
        half = np.full(m, self.start)
        lo = np.stack([np.searchsorted(s, at[:, i]) for i, s in enumerate(self.sorted)], axis=1)
        hi = lo.copy()
        counts = np.zeros((m, n), np.int16)
        found = [(np.empty(0, np.int64), np.empty(0)) for _ in range(m)]
        open_ = list(range(m))
        while open_:
            own = np.array(open_)
            low, high = at[own] - half[own, None], at[own] + half[own, None]
            new_lo, new_hi = np.empty((len(own), number), np.int64), np.empty((len(own), number), np.int64)
            for i, s in enumerate(self.sorted):
                new_lo[:, i] = np.searchsorted(s, low[:, i])
                new_hi[:, i] = np.searchsorted(s, high[:, i], side="right")
            new_lo, new_hi = np.minimum(new_lo, lo[own]), np.maximum(new_hi, hi[own])
            still = []
            for j, q in enumerate(open_):
                ring = [o[a:b] for o, a, b in zip(self.order, new_lo[j], lo[q], strict=True) if b > a]
                ring += [o[a:b] for o, a, b in zip(self.order, hi[q], new_hi[j], strict=True) if b > a]
                lo[q], hi[q] = new_lo[j], new_hi[j]
                places, distances = found[q]
                if ring:
                    before = counts[q] >= self.need
                    counts[q] += np.bincount(np.concatenate(ring), minlength=n).astype(np.int16)
                    fresh = np.flatnonzero((counts[q] >= self.need) & ~before)
                    if len(fresh):
                        far = np.sqrt(((self.vectors[fresh] - queries[q]) ** 2).sum(1))
                        found[q] = places, distances = np.concatenate([places, fresh]), np.concatenate([distances, far])
                if (lo[q] == 0).all() and (hi[q] == n).all():
                    continue
                wide = half[q] * GROW
                if len(places) >= k:
                    wanted = self.reach * np.partition(distances, k - 1)[k - 1]
                    if half[q] >= wanted:
                        continue
                    wide = min(wide, wanted)
                elif not ring:
                    # On to the next vector, however far away.
                    left = np.where(lo[q] > 0, at[q] - self.sorted[np.arange(number), np.maximum(lo[q] - 1, 0)], np.inf)
                    right = np.where(hi[q] < n, self.sorted[np.arange(number), np.minimum(hi[q], n - 1)] - at[q], np.inf)
                    wide = max(wide, float(min(left.min(), right.min())))
                half[q] = wide
                still.append(q)
            open_ = still
        return found


EMPTY = {"query_id": np.int64, "query": np.int64, "vec_id": np.int64, "score": np.float64}


def _nearest(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    """left: a shard; right: a block of queries. The block's k nearest rows of the shard, the query's own row left out."""
    out = []
    if len(left) and len(right):
        vectors = np.stack(left.v.to_numpy()).astype(np.float64)
        ids, rows = left.vec_id.to_numpy(np.int64), left.rows.to_numpy(np.int64)
        raw = np.ascontiguousarray(vectors).view(np.dtype((np.void, 8 * vectors.shape[1])))[:, 0]
        _, first, which = np.unique(raw, return_index=True, return_inverse=True)
        by = np.lexsort((ids, which))
        ends = np.r_[np.flatnonzero(np.diff(which[by])) + 1, len(by)]
        starts = np.r_[0, ends[:-1]]
        shard = Shard(vectors[first])
        asked, names, keys = np.stack(right.v.to_numpy()).astype(np.float64), right.vec_id.to_numpy(np.int64), right["query"].to_numpy(np.int64)
        for at in range(0, len(asked), BATCH):
            batch = slice(at, at + BATCH)
            for q, key, v, (places, distances) in zip(names[batch], keys[batch], asked[batch], shard.search(asked[batch], k + 1), strict=True):
                near = distances <= np.partition(distances, min(k, len(distances) - 1))[min(k, len(distances) - 1)]
                got = []
                for p, d in zip(places[near], distances[near], strict=True):
                    same = d == 0 and (shard.vectors[p] == v).all()
                    for i in by[starts[p]:min(ends[p], starts[p] + k + 1)]:
                        got += [(d, ids[i])] * min(k, rows[i] - (same and ids[i] == q))
                got.sort()
                out += [(q, key, i, d) for d, i in got[:k]]
    return pd.DataFrame(out, columns=list(EMPTY)).astype(EMPTY)


def search(embeddings: DataFrame, every: int = 100, k: int = 10, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query, by Euclidean distance.

    Queries are the rows whose vec_id is divisible by ``every``; candidates all rows but
    the query's own.  Null or zero vectors, vectors with null or non-finite components
    and rows with a null vec_id take no part; vectors meet only those of their own length.
    Rows that share a vec_id are candidates each; as queries, equal ones give one result, and different
    ones a result each.  Ties go to the smaller vec_id.  Fewer candidates than ``k`` give all of them; an
    empty table gives an empty result.
    """
    v = F.transform(F.col("embedding").cast("array<double>"), lambda x: x + 0.0)
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
        .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(fine))
    rows = rows.groupBy("vec_id", "v").agg(F.count("*").alias("rows"))
    rows = store(rows.select("vec_id", "v", "rows", F.size("v").alias("d"), F.xxhash64("vec_id", "v").alias("query")), "vectors")
    # One row for each length of vectors.
    sizes = rows.groupBy("d").agg(F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("m")).collect()
    shards = max([math.ceil(r.n / shard) for r in sizes], default=1)
    blocks = max([math.ceil(r.m / block) for r in sizes], default=1) or 1
    spot = F.pmod(F.xxhash64("query"), F.lit(shards)).cast("int").alias("s")
    to = F.pmod(F.xxhash64("query", F.lit(1)), F.lit(blocks)).cast("int").alias("b")
    # Each vector goes to every block of queries, each query to every shard: blocks, not pairs of rows.
    held = rows.select("d", spot, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), "vec_id", "v", "rows")
    asked = rows.filter(F.col("vec_id") % every == 0).select("d", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("s"), to, "vec_id", "v", "query")

    def nearest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _nearest(left, right, k)

    found = held.groupBy("d", "s", "b").cogroup(asked.groupBy("d", "s", "b")).applyInPandas(nearest, "query_id long, query long, vec_id long, score double")
    best = Window.partitionBy("query_id", "query").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
