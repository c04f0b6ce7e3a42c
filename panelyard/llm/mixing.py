"""Mixing sources to target weights: subset-sum budget fitting.

Each source gets a target number of words.  Whole repeats of the source fill
most of it; the rest is a budget for a subset of its documents.  Documents are
counted by exact length; a proportional share of each length is taken, rounding
is settled greedily from long to short, and a bounded knapsack (dynamic
programming over the remaining budget, lengths as items with their counts) fits
what remains.  Which documents of a length are taken is a matter of a seeded
hash alone, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import store, unused, words
from .ranking import rank_in_groups

#: No document is taken more often.
MOST = 3
#: Words of budget that dynamic programming fits; what is above goes by share and greedily.
CAPACITY = 1 << 15


def numbered(sizes: DataFrame) -> DataFrame:
    """``sizes`` with ``at``: the place of each source by code point, from 0, null last.  Ranges of sources are numbered apart."""
    order = F.col("source").asc_nulls_last()
    dealt = store(sizes.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources")
    counts = dealt.groupBy("part").agg(F.count("*").alias("n"))
    # As many rows as partitions.
    starts = counts.select(F.col("part").alias("_p"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("_start"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return dealt.withColumn("_place", place).join(starts, F.col("part") == F.col("_p")).select(*sizes.columns, (F.col("_start") + F.col("_place")).alias("at"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources by code point, null last, weigh ``weights`` in turn and share the sum
    of all sizes.  A target stops at ``most`` times the source's size; the excess
    goes to the others by weight until none is above: each round is one sum over the
    sources, however many they are.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    rows = store(numbered(sizes).select("source", "source_size", w.alias("w"), (F.col("source_size") * F.lit(float(most))).alias("cap")), "weights")
    total, open_ = rows.agg(F.sum("source_size"), F.sum("w")).first()
    share = (total or 0) / (open_ or 1)
    while True:
        full = F.col("w") * F.lit(share) > F.col("cap")
        spent, open_ = rows.agg(F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)), F.sum(F.when(~full, F.col("w")))).first()
        after = (total - spent) / open_ if open_ else share
        if after <= share:
            return rows.select("source", "source_size", F.least("cap", F.col("w") * F.lit(share)).alias("target"))
        share = after


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int = 17, capacity: int = CAPACITY) -> np.ndarray:
    """How many documents of each length to take so that their words come near ``budget``.

    ``lengths`` are different and positive.  A proportional share of every length,
    rounded down, comes first; then lengths in a seeded order give more documents until
    at most ``capacity`` words are left, which the knapsack fits.
    """
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    order = np.argsort((lengths.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15), kind="stable")
    take = np.array([int(c) * budget // total for c in counts], np.int64)
    left = budget - int((lengths * take).sum())
    for i in order:
        if left <= capacity:
            break
        size = int(lengths[i])
        more = min(int(counts[i] - take[i]), left // size, -((capacity - left) // size))
        take[i] += more
        left -= more * size
    take[order] += _knapsack(lengths[order], (counts - take)[order], min(left, capacity))
    return take


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack by bit sets: reach the sum nearest to ``budget``, below or above.

    Items join in the order given until ``budget`` itself is reached; memory is
    twice ``budget`` bits for each power-of-two share of an item.
    """
    take = np.zeros_like(counts)
    if budget <= 0:
        return take
    top = 2 * budget
    full = (1 << (top + 1)) - 1
    reach, steps = 1, []
    for i in range(len(lengths)):
        size = int(lengths[i])
        left, piece = min(int(counts[i]), top // size), 1
        while left > 0:
            n = min(piece, left)
            steps.append((i, n, size * n, reach))
            reach = (reach | (reach << (size * n))) & full
            left, piece = left - n, piece * 2
        if reach >> budget & 1:
            break
    at = (reach & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = reach >> budget
    if above:
        above = budget + (above & -above).bit_length() - 1
        at = above if above - budget < budget - at else at
    for i, n, size, before in reversed(steps):
        if not before >> at & 1:
            take[i] += n
            at -= size
    return take


def _fitted(rows: pd.DataFrame, seed: int, capacity: int) -> pd.DataFrame:
    size, target = int(rows.source_size.iloc[0]), float(rows.target.iloc[0])
    whole = min(int(target // size), MOST)
    rest = min(size, max(0, round(target - whole * size))) if whole < MOST else 0
    quota = fit(rows["size"].to_numpy(np.int64), rows.n.to_numpy(np.int64), rest, seed, capacity)
    return pd.DataFrame({"source": rows.source, "size": rows["size"], "whole": whole, "quota": quota})


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), seed: int = 17, capacity: int = CAPACITY, keep: bool = False) -> DataFrame:
    """doc_id, size, source_size, target and taken (words the mix takes) for every row.

    size: the text's number of words; null text has 0 and takes none.  With
    ``keep`` also ``row_key``, a hash of the whole row, and ``times``.  taken is a multiple of size, 0 to 3
    times.  Documents of no words take 0; a source of no words has target 0.
    Rows that are equal in every respect may stand in for one another.
    """
    def fitted(rows: pd.DataFrame) -> pd.DataFrame:
        return _fitted(rows, seed, capacity)

    size = F.size(words(F.col("text").cast("string"))).cast("long").alias("size")
    cols = ["doc_id", F.col("source").cast("string").alias("source"), size, *([row_key(docs)] if keep else [])]
    sized = store(docs.select(*cols).withColumn("h", F.xxhash64(F.lit(seed), "doc_id")), "sizes")
    histogram = store(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram")
    goal = store(targets(histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights), "targets")
    same = histogram["source"].eqNullSafe(goal["source"])
    quota = store(
        histogram.filter("size > 0").join(goal, same).select(histogram["source"], "size", "n", "source_size", "target")
        .groupBy("source").applyInPandas(fitted, "source string, size long, whole int, quota long"), "quota")
    ranked = rank_in_groups(sized, ["source", "size"], ["h", "doc_id"])
    q = quota.select(F.col("source").alias("_s"), F.col("size").alias("_z"), "whole", "quota")
    g = goal.select(F.col("source").alias("_gs"), "source_size", "target")
    times = F.coalesce(F.col("whole") + F.when(F.col("rank") < F.col("quota"), 1).otherwise(0), F.lit(0))
    return (
        ranked.join(q, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z")), "left")
        .join(g, F.col("source").eqNullSafe(F.col("_gs")), "left")
        .select("doc_id", "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"),
                *(["row_key", times.cast("int").alias("times")] if keep else [])))


def row_key(docs: DataFrame) -> Column:
    """A hash of the whole row; columns that hold maps, which have no hash, by their text."""
    return F.xxhash64(*[F.col(f"`{c}`").cast("string") if "map<" in kind else F.col(f"`{c}`") for c, kind in docs.dtypes]).alias("row_key")


def taken(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them.

    Texts move once, next to their number of times.  Rows that are equal in every respect meet there: one of
    them stands for all.
    """
    id_, key, times, rows = unused(docs, "_id", "_key", "_times", "_rows")
    found = mix(docs, keep=True, **options).groupBy("doc_id", "row_key").agg(F.sum("times").alias(times), F.count("*").alias(rows))
    found = store(found.filter(F.col(times) > 0).select(F.col("doc_id").alias(id_), F.col("row_key").alias(key), times, rows), "times")
    cols = [F.col(f"`{c}`") for c in docs.columns]
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (row_key(docs) == F.col(key))
    joined = docs.join(found.hint("shuffle_hash"), same).select(*cols, id_, key, times, rows)
    if not found.filter(F.col(rows) > 1).isEmpty():
        joined = joined.filter(F.col(rows) == 1).union(joined.filter(F.col(rows) > 1).dropDuplicates([id_, key]))
    return joined.withColumn(rows, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))).select(*cols)
