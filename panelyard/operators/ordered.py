"""Running sums and exact quantiles over a whole table, in two phases.

No task gets more than its range of the order: approximate quantiles cut the values into
ranges, range totals give each range's start, and windows run inside ranges.  The cut decides
only how the work is dealt; results are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelyard.sources.tables import settled

#: Rows of a range, about, and ranges that a table is cut into at least.
ROWS, PARTS = 250_000, 16


def ranges(df: DataFrame) -> int:
    """How many ranges ``df`` is cut into: more for a larger table."""
    return max(PARTS, -(-df.count() // ROWS))


def _edges(order, parts: int):
    """Approximate quantiles that cut an order into ``parts`` ranges, ten times finer than they are wide."""
    return F.percentile_approx(order, F.array(*[F.lit((i + 1) / parts) for i in range(parts - 1)]), 10 * max(parts, 100))


def running(df: DataFrame, order: str, sums: list[str], by: list[str] = (), parts: int | None = None) -> DataFrame:
    """Adds ``cum_<c>`` for each of ``sums``: its sum over rows up to and with this one, by rising ``order``.

    ``order`` is different in every row of a group.
    """
    by = list(by)
    edges = df.groupBy(*by).agg(_edges(order, parts or ranges(df)).alias("_edges"))
    if by:
        edges = edges.select(*[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)], "_edges")
        on = F.lit(True)
        for i, b in enumerate(by):
            on = on & F.col(b).eqNullSafe(F.col(f"_by{i}"))
        cut = df.join(edges, on).drop(*[f"_by{i}" for i in range(len(by))])
    else:
        cut = df.withColumn("_edges", F.coalesce(edges.scalar(), F.array().cast("array<double>")))
    cut = cut.withColumn("_range", F.size(F.filter("_edges", lambda e: e < F.col(order)))).drop("_edges")
    totals = cut.groupBy(*by, "_range").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)], F.col("_range").alias("_r"), *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_s_{c}") for c in sums])
    on = F.col("_range") == F.col("_r")
    for i, b in enumerate(by):
        on = on & F.col(b).eqNullSafe(F.col(f"_by{i}"))
    inside = Window.partitionBy(*by, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return cut.join(starts, on).select(*df.columns, *[(F.col(f"_s_{c}") + F.sum(c).over(inside)).alias(f"cum_{c}") for c in sums])


def quantiles(df: DataFrame, value: str, probabilities: list[float], by: list[str] = ()) -> DataFrame:
    """(by, n, quantiles): exact quantiles with linear interpolation; nulls and NaN are left out."""
    by = list(by)
    counts = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    counts = settled(counts)
    placed = running(counts, "_v", ["_n"], by).withColumn("_all", F.sum("_n").over(Window.partitionBy(*by)) if by else F.coalesce(counts.agg(F.sum("_n")).scalar(), F.lit(0)))
    before = F.col("cum__n") - F.col("_n")

    def at(place):
        return F.max(F.when((before <= place) & (place < F.col("cum__n")), F.col("_v")))

    found = []
    for p in probabilities:
        place = F.lit(float(p)) * (F.col("_all") - 1)
        found.append((at(F.floor(place)), at(F.ceil(place)), F.max(place - F.floor(place))))
    return placed.groupBy(*by).agg(F.max("_all").alias("n"), F.array(*[lo + (hi - lo) * part for lo, hi, part in found]).alias("quantiles"))


def long(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """(keep, feature, value): columns turned to rows, values as doubles."""
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*keep, F.inline(rows))


def numbered(df: DataFrame, order: list[str], name: str, parts: int | None = None) -> DataFrame:
    """Adds the row's number, from 0, in the order of ``order``, whose first column is a number, date or time."""
    first = F.unix_timestamp(F.col(order[0]).cast("timestamp")).cast("double") if dict(df.dtypes)[order[0]] in ("date", "timestamp", "timestamp_ntz") else F.col(order[0]).cast("double")
    edges = sorted(set(df.agg(_edges(first, parts or ranges(df))).first()[0] or []))
    at = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < first)) if edges else F.lit(0)
    cut = df.withColumn("_range", F.when(first.isNull(), -1).otherwise(at))
    sizes = {r[0]: r[1] for r in cut.groupBy("_range").count().collect()}
    start, before = F.lit(0).cast("long"), 0
    for r in sorted(sizes):
        start = F.when(F.col("_range") == r, F.lit(before).cast("long")).otherwise(start)
        before += sizes[r]
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return cut.withColumn(name, start + place).drop("_range")


def top(df: DataFrame, by: list[str], order: list, k: int, rank: str = "_rank", shares: int = 64) -> DataFrame:
    """The first ``k`` rows of each group, ranked from 1: first of every share of the group, then of what they leave."""
    spread = df.withColumn("_share", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(shares)))
    some = spread.withColumn(rank, F.row_number().over(Window.partitionBy(*by, "_share").orderBy(*order))).filter(F.col(rank) <= k)
    return some.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(rank) <= k).drop("_share")
