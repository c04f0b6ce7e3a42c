"""Exact ranks inside groups of which one may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A group is dealt over so many hash buckets; no task sorts more than one of them at once.
BUCKET_BITS = 10


def rank_in_groups(df: DataFrame, keys: list[str], order: list[str], rank: str = "rank") -> DataFrame:
    """Add ``rank``: 0, 1, ... inside each group of ``keys``, by a seeded hash column first.

    ``order[0]`` must be a long that is spread evenly (a hash); its top bits cut
    each group into buckets that keep the order.  Bucket sizes are counted with
    map-side combining, their running sums (at most 2**BUCKET_BITS rows a group)
    give each bucket's first rank, and only rows of one bucket are sorted
    together.  Null keys form a group of their own.
    """
    bucket = F.shiftright(F.col(order[0]), 64 - BUCKET_BITS).cast("int")
    rows = df.withColumn("_bucket", bucket)
    full = [*keys, "_bucket"]
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        rows.groupBy(*full).agg(F.count("*").alias("_n"))
        .withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    first = first.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(full)], "_first")
    place = F.row_number().over(Window.partitionBy(*full).orderBy(*order)) - 1
    placed = rows.withColumn("_place", place)
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(full)]
    on = same[0]
    for more in same[1:]:
        on = on & more
    return (
        placed.join(first, on, "left")
        .withColumn(rank, (F.col("_first") + F.col("_place")).cast("long"))
        .drop("_bucket", "_place", "_first", *[f"_k{i}" for i in range(len(full))])
    )
