"""Segment and portfolio aggregates, transitions and trends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelyard.functions import scalar as S

SEGMENTS = ("vintage_year", "credit_score_band", "state", "servicer_name")


def segments(panel: DataFrame, by: tuple[str, ...] = SEGMENTS) -> DataFrame:
    """One row for each value of each segment: rows, entities, balance and rates, in one aggregation over all segments."""
    rows = F.array(*[F.struct(F.lit(s).alias("segment"), F.col(s).cast("string").alias("value")) for s in by])
    flat = panel.select("loan_id", "current_balance", "delinquency", "default_flag", "prepayment_flag", F.inline(rows))
    share = lambda c: F.avg(F.col(c).cast("int").cast("double"))
    return flat.groupBy("segment", "value").agg(
        F.count("*").alias("n_records"), F.countDistinct("loan_id").alias("n_entities"), F.sum(F.col("current_balance").cast("decimal(20,2)")).cast("double").alias("sum_balance"),
        share("delinquency").alias("delinquency_rate"), share("default_flag").alias("default_rate"), share("prepayment_flag").alias("prepayment_rate"))


def top_segments(panel: DataFrame, by: tuple[str, ...] = SEGMENTS, k: int = 12) -> DataFrame:
    """The ``k`` values of each segment with most records."""
    w = Window.partitionBy("segment").orderBy(F.desc("n_records"), F.asc_nulls_first("value"))
    return segments(panel, by).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def servicer_features(panel: DataFrame) -> DataFrame:
    """The servicer's monthly delinquency rate and size beside each row."""
    by = panel.groupBy("servicer_name", "reporting_month").agg(F.avg(F.col("delinquency").cast("int").cast("double")).alias("servicer_delinquency_rate"), F.count("*").alias("servicer_records"))
    return panel.join(by, ["servicer_name", "reporting_month"], "left").select("loan_id", "reporting_month", "servicer_name", "servicer_delinquency_rate", "servicer_records")


def age_buckets(panel: DataFrame, edges: tuple[int, ...] = (12, 24, 36, 60, 120)) -> DataFrame:
    """(age_bucket, n_records, default_rate): months since origination in bands, closed above; null ages are ``unknown``."""
    age, low, bucket = F.col("loan_age_months"), 0, F.when(F.col("loan_age_months").isNull(), "unknown")
    for edge in edges:
        bucket, low = bucket.when(age <= edge, f"{low}-{edge}"), edge + 1
    rows = panel.select(bucket.otherwise(f"{low}+").alias("age_bucket"), F.col("default_flag").cast("int").cast("double").alias("d"))
    return rows.groupBy("age_bucket").agg(F.count("*").alias("n_records"), F.avg("d").alias("default_rate"))


def encodings(static: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, code, n, share): a code for each category, from 0 by falling count, then value; nulls come last as ``?``.

    Categories are few, whatever the rows.
    """
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("?")).alias("value")) for c in columns])
    counts = static.select(F.inline(rows)).groupBy("column", "value").agg(F.count("*").alias("n"))
    by = Window.partitionBy("column")
    code = F.row_number().over(by.orderBy((F.col("value") == "?").cast("int"), F.desc("n"), "value")) - 1
    return counts.select("column", "value", code.alias("code"), "n", (F.col("n") / F.sum("n").over(by)).alias("share"))


def transitions(panel: DataFrame) -> DataFrame:
    """(from_state, to_state, n, share of the from-state) over consecutive rows of an entity."""
    w = Window.partitionBy("loan_id").orderBy("reporting_month")
    pairs = panel.select(F.col("current_status").alias("from_state"), F.lead("current_status").over(w).alias("to_state")).filter("to_state is not null")
    counts = pairs.groupBy("from_state", "to_state").agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("from_state")))


def latest(panel: DataFrame) -> DataFrame:
    """The last row of each entity, combined before the shuffle."""
    rest = [c for c in panel.columns if c != "loan_id"]
    return panel.groupBy("loan_id").agg(F.max_by(F.struct(*rest), F.col("reporting_month")).alias("_r")).select("loan_id", *[F.col(f"_r.`{c}`").alias(c) for c in rest])


def as_of(panel: DataFrame, asked: DataFrame) -> DataFrame:
    """For each (loan_id, as_of) the entity's last row not after it; nulls where there is none."""
    known = panel.select(F.col("loan_id").alias("_loan"), "reporting_month", "current_status", "current_balance")
    joined = asked.join(known, (F.col("loan_id") == F.col("_loan")) & (F.col("reporting_month") <= F.col("as_of")), "left")
    return joined.groupBy("loan_id", "as_of").agg(F.max_by(F.struct("reporting_month", "current_status", "current_balance"), F.col("reporting_month")).alias("_r")).select("loan_id", "as_of", "_r.*")


def trends(panel: DataFrame, segment: str | None = None) -> DataFrame:
    """Monthly rates, by segment if wanted, with the change from the month before."""
    keys = [segment] if segment else []
    by = panel.groupBy(*keys, "reporting_month").agg(F.count("*").alias("n_records"), F.avg(F.col("delinquency").cast("int").cast("double")).alias("delinquency_rate"))
    return by.withColumn("change", F.col("delinquency_rate") - F.lag("delinquency_rate").over(Window.partitionBy(*keys).orderBy("reporting_month")))


def quality_trend(ruled: DataFrame, alert: float = 5.0) -> DataFrame:
    """Monthly data-quality score and exception rate; a fall of more than ``alert`` points raises a flag."""
    by = ruled.groupBy("reporting_month").agg(F.avg("dq_score").alias("dq_score"), F.avg((F.col("dq_penalty") > 0).cast("int").cast("double")).alias("exception_rate"))
    change = F.col("dq_score") - F.lag("dq_score").over(Window.partitionBy().orderBy("reporting_month"))
    return by.select("*", change.alias("change"), S.truth(change < -alert).alias("alert"))


def timeline(ruled: DataFrame, feed: DataFrame) -> DataFrame:
    """Status changes, feed updates and exceptions of entities on one axis."""
    w = Window.partitionBy("loan_id").orderBy("reporting_month")
    status = ruled.select("loan_id", F.col("reporting_month").alias("at"), "current_status", F.lag("current_status").over(w).alias("_p")).filter("_p is null or _p <> current_status")
    return (
        status.select("loan_id", "at", F.lit("status").alias("kind"), F.col("current_status").alias("detail"))
        .unionByName(feed.select("loan_id", F.col("last_updated_on").alias("at"), F.lit("feed").alias("kind"), F.col("feed_status").alias("detail")))
        .unionByName(ruled.filter("exception_type is not null").select("loan_id", F.col("reporting_month").alias("at"), F.lit("exception").alias("kind"), F.col("exception_type").alias("detail"))))
