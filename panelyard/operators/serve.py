"""What an API would answer, as frames: listings, details, predictions with a grounded summary, submissions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelyard.functions import scalar as S
from panelyard.operators.segments import latest
from panelyard.plans import contract as C

DEFAULT_PAGE, MOST_PAGE = 25, 200
#: Answers for entities that have no scores.
FALLBACK = {"next_3m_delinquency_flag": 0.15, "next_12m_default_flag": 0.05, "next_12m_prepayment_flag": 0.20}


def page(df: DataFrame, order: list[Column], number: int = 1, size: int = DEFAULT_PAGE) -> DataFrame:
    """Page ``number`` (from 1) of at most MOST_PAGE rows, by an order that leaves no ties."""
    size = max(1, min(size, MOST_PAGE))
    return df.orderBy(*order).offset((max(1, number) - 1) * size).limit(size)


def after(df: DataFrame, key: str, last, size: int = DEFAULT_PAGE) -> DataFrame:
    """Keyset paging: the rows that follow ``last``; the filter reaches the scan."""
    rows = df if last is None else df.filter(F.col(key) > F.lit(last))
    return rows.orderBy(key).limit(max(1, min(size, MOST_PAGE)))


def loans(static: DataFrame, state: str | None = None, band: str | None = None, purpose: str | None = None, **paging) -> DataFrame:
    for column, value in (("state", state), ("credit_score_band", band), ("loan_purpose", purpose)):
        if value is not None:
            static = static.filter(F.col(column) == value)
    cols = ["loan_id", "state", "credit_score_band", "ltv_band", "dti_band", "loan_purpose", "original_balance", "vintage_year"]
    return page(static.select(*cols), [F.col("loan_id")], **paging)


def loan_detail(static: DataFrame, panel: DataFrame, loan_id: str | None = None) -> DataFrame:
    """The dimension with the entity's latest month; of one entity, or of all."""
    if loan_id is not None:
        static, panel = static.filter(F.col("loan_id") == loan_id), panel.filter(F.col("loan_id") == loan_id)
    last = latest(panel.select("loan_id", "reporting_month", "current_status", "current_balance", "days_past_due", "loan_age_months"))
    return static.join(last, "loan_id", "left")


def anomalies(scored: DataFrame, min_score: float = 0.0, exception_type: str | None = None, reviewed: bool | None = None, reviews: DataFrame | None = None, **paging) -> DataFrame:
    """A page of anomalies; ``reviewed`` keeps those with, or without, a row in ``reviews`` (loan_id, reporting_month)."""
    rows = scored.filter(F.col("anomaly_score") >= min_score)
    if reviewed is not None:
        rows = rows.join(reviews, ["loan_id", "reporting_month"], "left_semi" if reviewed else "left_anti")
    if exception_type is not None:
        rows = rows.filter(F.col("exception_type") == exception_type)
    cols = ["loan_id", "reporting_month", "anomaly_score", "exception_type", "reason"]
    return page(rows.select(*cols), [F.desc("anomaly_score"), F.col("loan_id"), F.col("reporting_month")], **paging)


def risk_level(p: Column) -> Column:
    return S.level(p, C.RISK_LEVELS)


def action(anomaly: Column, p_default: Column) -> Column:
    return F.when(S.truth(anomaly) | S.truth(p_default > 0.1), "Review").otherwise("Auto-Approve")


def summary(p_default: Column, anomaly: Column, drivers: Column, exception: Column) -> Column:
    """A reviewer's text from nothing but the given values: the rule's description, drivers and P(default)."""
    known = {t.exception_type: f"{r}: {t.description}" for r, t in C.RULES.items()}
    rule = S.decode(exception, known, None)
    flagged = F.concat(
        F.lit("Warning: the anomaly detector flagged this record."), F.when(F.size(drivers) > 0, F.concat(F.lit(" High risk drivers: "), F.concat_ws(", ", drivers), F.lit("."))).otherwise(""),
        F.coalesce(F.concat(F.lit(" Specific rule violations found: "), rule, F.lit(".")), F.lit("")))
    return F.concat(
        F.lit("Reviewer summary for loan "), F.col("loan_id"), F.lit(": default probability "), F.format_string("%.1f", F.coalesce(p_default, F.lit(0.0)) * 100), F.lit("%. "),
        F.when(S.truth(anomaly), flagged).otherwise("No anomalies detected."))


def submission(scored: DataFrame, targets: list[str]) -> DataFrame:
    """One row for each scored row: probabilities and drivers as JSON, state, anomaly, action and confidence."""
    pairs = [x for t in targets for x in (F.lit(t), F.col(t))]
    anomaly = F.col("anomaly_score") > 0.5
    return scored.select(
        "loan_id", F.to_json(F.create_map(*pairs)).alias("probabilities"), F.col("predicted_state").alias("next_state"), "anomaly_score", F.coalesce("exception_type", F.lit("None")).alias("exception_type"),
        F.to_json("drivers").alias("drivers"), action(anomaly, F.col("next_12m_default_flag")).alias("action"), "confidence")


def predict(asked: DataFrame, submission: DataFrame) -> DataFrame:
    """Answers for asked loan_ids from a submission; unknown ones get fixed fallback probabilities."""
    one = submission.dropDuplicates(["loan_id"])
    joined = asked.select("loan_id").join(one, "loan_id", "left")
    probs = F.from_json("probabilities", "map<string, double>")
    unknown = F.col("probabilities").isNull()
    named = {t: F.when(unknown, v).otherwise(F.coalesce(F.try_element_at(probs, F.lit(t)), F.lit(0.0))) for t, v in FALLBACK.items()}
    anomaly = S.truth((F.col("anomaly_score") > 0.5) | (F.col("action") == "Review"))
    rows = joined.select("loan_id", *[c.alias(t.replace("_flag", "_prob")) for t, c in named.items()], anomaly.alias("is_anomaly"), "exception_type", F.from_json("drivers", "array<struct<feature:string,contribution:double,effect:string>>").alias("_d"))
    fields = F.coalesce(F.transform("_d", lambda d: d["feature"]), F.array().cast("array<string>"))
    return rows.withColumn("reviewer_summary", summary(F.col("next_12m_default_prob"), F.col("is_anomaly"), fields, F.col("exception_type"))).drop("_d", "exception_type")
