"""Cleaning without silent loss: what leaves the panel is in the quarantine with its reason."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelyard.functions import scalar as S
from panelyard.functions.windows import filled

KEYS = ["loan_id", "reporting_month"]


def deduplicate(rows: DataFrame, keys: list[str] = KEYS, seq: str = "ingest_seq") -> tuple[DataFrame, DataFrame]:
    """(panel, quarantine): rows with a null key go; equal rows count once, the first; of rows that differ
    under one key all go to the quarantine and the first also stays.

    Everything runs on one exchange by the first key; ``seq`` orders rows and is no part of equality.
    """
    lost = F.lit(False)
    for k in keys:
        lost = lost | F.col(k).isNull()
    values = [c for c in rows.columns if c != seq]
    spread = rows.filter(~lost).repartition(keys[0])
    ranked = spread.withColumn("_copy", F.row_number().over(Window.partitionBy(*values).orderBy(seq))).filter("_copy = 1")
    key = Window.partitionBy(*keys)
    ranked = ranked.withColumn("_n", F.count("*").over(key)).withColumn("_at", F.row_number().over(key.orderBy(seq)))
    panel = ranked.filter("_at = 1").select(*rows.columns)
    missing = rows.filter(lost).select(*rows.columns, F.lit("missing_primary_key").alias("quarantine_reason"))
    conflicts = ranked.filter("_n > 1").select(*rows.columns, F.lit("conflicting_duplicate_loan_month").alias("quarantine_reason"))
    return panel, missing.unionByName(conflicts)


def repair(panel: DataFrame) -> DataFrame:
    """Unreported status to zero months under a flag; missing balances from the entity's neighbouring months under flags."""
    reported = panel.select(
        *[c for c in panel.columns if c not in ("dlq_months", "days_past_due")], F.col("dlq_months").isNull().alias("dlq_status_unreported"),
        F.coalesce("dlq_months", F.lit(0)).alias("dlq_months"), F.coalesce("days_past_due", F.lit(0.0)).alias("days_past_due"),
        ((F.coalesce("current_balance", F.lit(0.0)) <= 0) & ~F.col("is_terminated")).alias("balance_imputed"))
    known = F.when(~F.col("balance_imputed"), F.col("current_balance"))
    full = reported.withColumn("_b", known).withColumn("current_balance", filled(F.col("_b"))).drop("_b")
    return full.withColumn("balance_unrecoverable", F.col("current_balance").isNull())


def clean_panel(monthly: DataFrame) -> tuple[DataFrame, DataFrame]:
    panel, quarantine = deduplicate(monthly)
    return repair(panel), quarantine


def impute_by_segment(df: DataFrame, column: str, segment: str) -> DataFrame:
    """Nulls take the segment's median, under a flag."""
    medians = df.groupBy(segment).agg(F.median(column).alias("_median"))
    joined = df.join(medians, df[segment].eqNullSafe(medians[segment]), "left").select(df["*"], "_median")
    return joined.select(*[c for c in df.columns if c != column], F.coalesce(F.col(column), F.col("_median")).alias(column), F.col(column).isNull().alias(f"{column}_imputed"))


def reconcile(primary: DataFrame, feed: DataFrame) -> DataFrame:
    """Panel rows against the feed's newest row for the same key: conflict, staleness and the status that wins.

    The feed wins where it differs, is not stale and was updated after the reporting month's end; otherwise the primary stays and a
    remaining difference is flagged.
    """
    newest = feed.groupBy(*KEYS).agg(F.max_by(F.struct("feed_status", "last_updated_on", "is_stale"), F.struct("last_updated_on", "feed_status")).alias("_f"))
    joined = primary.join(newest, KEYS, "left")
    differs = S.truth(F.col("_f.feed_status") != F.col("current_status"))
    wins = differs & ~S.truth(F.col("_f.is_stale")) & S.truth(F.col("_f.last_updated_on") > F.last_day("reporting_month"))
    return joined.select(
        *KEYS, "current_status", F.col("_f.feed_status").alias("feed_status"), differs.alias("has_conflict"), F.coalesce("_f.is_stale", F.lit(False)).alias("is_stale"),
        F.when(wins, F.col("_f.feed_status")).otherwise(F.col("current_status")).alias("reconciled_status"), (differs & ~wins).alias("unresolved"))
