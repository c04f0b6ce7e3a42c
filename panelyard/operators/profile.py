"""Profiles of tables: columns, missing values, distributions, associations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelyard.functions import scalar as S
from panelyard.operators.ordered import long, quantiles, top


def columns(df: DataFrame, names: list[str], examples: int = 3, approximate: bool = False) -> DataFrame:
    """Per string column: fill rate, distinct values, the most frequent ones, least and greatest length.

    Blank counts as missing.  ``approximate`` estimates distinct values and skips examples, for tables whose
    columns have more values than should be counted.
    """
    rows = F.array(*[F.struct(F.lit(i).alias("idx"), F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("v")) for i, c in enumerate(names)])
    turned = df.select(F.inline(rows))
    filled = F.col("v") != ""
    if approximate:
        return turned.groupBy("idx", "column").agg(
            F.count("*").alias("n"), F.avg(filled.cast("int").cast("double")).alias("fill_rate"), F.approx_count_distinct(F.when(filled, F.col("v"))).alias("n_distinct"),
            F.coalesce(F.min(F.when(filled, F.length("v"))), F.lit(0)).alias("min_len"), F.coalesce(F.max(F.length("v")), F.lit(0)).alias("max_len"))
    values = turned.groupBy("idx", "column", "v").agg(F.count("*").alias("n"))
    shown = top(values.filter(filled), ["idx"], [F.desc("n"), "v"], examples).groupBy("idx").agg(F.array_sort(F.collect_list(F.struct("_rank", "v"))).alias("_e"))
    return values.groupBy("idx", "column").agg(
        F.sum("n").alias("n"), (F.sum(F.when(filled, F.col("n")).otherwise(0)) / F.sum("n")).alias("fill_rate"), F.count_if(filled).alias("n_distinct"),
        F.coalesce(F.min(F.when(filled, F.length("v"))), F.lit(0)).alias("min_len"), F.max(F.length("v")).alias("max_len")).join(shown, "idx", "left").select(
        "idx", "column", "n", "fill_rate", "n_distinct", F.coalesce(F.array_join(F.transform("_e", lambda x: x["v"]), ","), F.lit("")).alias("examples"), "min_len", "max_len")


def widths(lines: DataFrame, column: str = "value", sep: str = "|") -> DataFrame:
    """How often each number of fields occurs; the first row is the modal width."""
    n = F.length(column) - F.length(F.replace(F.col(column), F.lit(sep), F.lit(""))) + 1
    return lines.groupBy(n.cast("int").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width")


def value_counts(df: DataFrame, column: str, most: int = 20) -> DataFrame:
    """The most frequent values, null among them."""
    return df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_first("value")).limit(most)


def missingness(df: DataFrame, names: list[str], period: str) -> DataFrame:
    """Missing share by column and period, and its change from the period before."""
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).isNull().cast("long").alias("m")) for c in names])
    by = df.select(F.col(period).alias("period"), F.inline(rows)).groupBy("column", "period").agg(F.count("*").alias("n"), F.sum("m").alias("n_missing"))
    share = by.withColumn("missing_rate", F.col("n_missing") / F.col("n"))
    return share.withColumn("change", F.col("missing_rate") - F.lag("missing_rate").over(Window.partitionBy("column").orderBy("period")))


def correlations(df: DataFrame, names: list[str]) -> DataFrame:
    """Pearson's correlation of every pair, in one aggregation."""
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    one = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)])))


def cramers_v(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cramér's V of two categories, from their contingency table."""
    cells = df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("o"))
    rows = cells.withColumn("ra", F.sum("o").over(Window.partitionBy("a"))).withColumn("rb", F.sum("o").over(Window.partitionBy("b"))).withColumn("n", F.sum("o").over(Window.partitionBy()))
    stats = rows.agg(F.max("n").alias("n"), F.sum(F.col("o").cast("double") * F.col("o") / (F.col("ra").cast("double") * F.col("rb"))).alias("s"), F.countDistinct("a").alias("ka"), F.countDistinct("b").alias("kb"))
    return stats.select("n", F.sqrt(F.greatest(F.col("s") - 1, F.lit(0.0)) / F.nullif(F.least("ka", "kb") - 1, F.lit(0))).alias("cramers_v"))


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts by equal bins; 0 below and bins + 1 at or above the range."""
    at = F.width_bucket(F.col(column).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    return df.filter(F.col(column).isNotNull()).groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def outliers(df: DataFrame, names: list[str], key: list[str], factor: float = 1.5) -> DataFrame:
    """(key, feature, value) of values beyond ``factor`` interquartile ranges from the quartiles."""
    rows = long(df, names, key)
    fences = quantiles(rows, "value", [0.25, 0.75], ["feature"]).select("feature", F.col("quantiles")[0].alias("_q1"), F.col("quantiles")[1].alias("_q3"))
    reach = (F.col("_q3") - F.col("_q1")) * factor
    return rows.join(fences, "feature").filter((F.col("value") < F.col("_q1") - reach) | (F.col("value") > F.col("_q3") + reach)).select(*key, "feature", "value")


def date_checks(panel: DataFrame, low: str, cutoff: str) -> DataFrame:
    """Rows with an implausible date: before ``low`` or after ``cutoff``."""
    c = F.col("reporting_month")
    early, late = c < F.lit(low).cast("date"), c > F.lit(cutoff).cast("date")
    return panel.filter(S.truth(early | late)).select("loan_id", "reporting_month", F.when(late, "after_cutoff").otherwise("before_range").alias("problem"))
