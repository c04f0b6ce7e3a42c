"""Engineered features: all trailing, all on the entity's one exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelyard.functions import scalar as S
from panelyard.functions.windows import before, by_entity, since, to_date, trailing
from panelyard.plans import contract as C


def financial() -> dict:
    c = F.col
    used = S.ratio(c("current_balance"), c("original_balance"))
    reduced = S.ratio(c("original_balance") - c("current_balance"), c("original_balance"))
    elapsed = S.ratio(c("loan_age_months").cast("double"), c("original_term_months").cast("double"))
    return {
        "loan_utilization": used, "balance_reduction_ratio": reduced, "remaining_balance_pct": used * 100, "term_elapsed_pct": elapsed,
        "amortisation_gap": elapsed - reduced, "rate_gap": c("current_interest_rate") - c("interest_rate"),
        "deferred_balance_pct": S.ratio(c("non_interest_bearing_upb"), c("original_balance")),
    }


def temporal() -> dict:
    c, w = F.col, by_entity()
    dpd, late, bal = c("days_past_due"), c("delinquency").cast("int"), c("current_balance")
    out = {"dpd_lag_1": F.lag(dpd, 1).over(w), "dpd_lag_3": F.lag(dpd, 3).over(w), "dpd_delta_1m": dpd - F.lag(dpd, 1).over(w)}
    for k in C.ROLLING:
        out |= {f"dpd_mean_{k}m": F.avg(dpd).over(trailing(k)), f"dpd_max_{k}m": F.max(dpd).over(trailing(k)), f"delinquent_months_{k}m": F.sum(late).over(trailing(k)).cast("double")}
    past = F.coalesce(F.sum(late).over(before()), F.lit(0)).cast("double")
    previous = F.lag(bal, 1).over(w)
    return out | {
        "cum_delinquent_months": past, "ever_delinquent": (past > 0).cast("int"), "cum_missed_payments": F.coalesce(F.max("dlq_months").over(to_date()), F.lit(0)).cast("double"),
        "balance_delta_1m": bal - previous, "balance_delta_3m": bal - F.lag(bal, 3).over(w), "balance_pct_change_1m": S.ratio(bal - previous, previous),
        "months_since_modification": since(S.truth(c("modification_flag")), c("month_index")).cast("double"), "ever_modified": F.max(S.flag(c("modification_flag"))).over(to_date()),
        "ever_forbearance": F.max(S.flag(c("forbearance_flag"))).over(to_date()), "forbearance_months": F.sum(S.flag(c("forbearance_flag"))).over(to_date()).cast("double"),
    }


def risk() -> dict:
    c = F.col
    part = lambda x: F.coalesce(x, F.lit(0.5))
    score = part((850.0 - S.clip(c("credit_score"), 300, 850)) / 550.0)
    ltv, dti = part(S.clip(c("ltv"), 0, 125) / 125.0), part(S.clip(c("dti"), 0, 65) / 65.0)
    age = c("loan_age_months").cast("double")
    return {
        "credit_risk_score": (0.45 * score + 0.35 * ltv + 0.20 * dti) * 100.0, "debt_burden": c("dti") * c("interest_rate") / 100.0, "equity_cushion": 100.0 - c("ltv"),
        "loan_age_risk": S.clip(1.0 - F.abs(age - 36.0) / 60.0, 0, 1), "is_seasoned": S.flag(age >= 36), "high_ltv_flag": S.flag(c("ltv") > 80),
        "subprime_flag": S.flag(c("credit_score") < 660), "high_dti_flag": S.flag(c("dti") > 43),
    }


def interaction() -> dict:
    """Needs the financial and temporal features."""
    c = F.col
    weak = (850.0 - c("credit_score")) / 550.0
    return {
        "credit_x_ltv": weak * (c("ltv") / 100.0), "dti_x_rate": (c("dti") / 100.0) * c("interest_rate"), "credit_x_dti": weak * (c("dti") / 100.0),
        "dlqhist_x_ltv": c("cum_delinquent_months") * (c("ltv") / 100.0), "amortgap_x_rate": c("amortisation_gap") * c("interest_rate"),
    }


FAMILIES = {"financial": financial, "temporal": temporal, "risk": risk, "interaction": interaction}


def build(panel: DataFrame) -> DataFrame:
    """The panel (with the dimension and month_index) and all 42 features."""
    first = panel.select("*", *[v.alias(k) for f in ("financial", "temporal", "risk") for k, v in FAMILIES[f]().items()])
    return first.select("*", *[v.alias(k) for k, v in interaction().items()])


#: The features of each family, in order.
NAMES = {
    "financial": ["loan_utilization", "balance_reduction_ratio", "remaining_balance_pct", "term_elapsed_pct", "amortisation_gap", "rate_gap", "deferred_balance_pct"],
    "temporal": [
        "dpd_lag_1", "dpd_lag_3", "dpd_delta_1m", *[f"{n}_{k}m" for k in C.ROLLING for n in ("dpd_mean", "dpd_max", "delinquent_months")], "cum_delinquent_months", "ever_delinquent",
        "cum_missed_payments", "balance_delta_1m", "balance_delta_3m", "balance_pct_change_1m", "months_since_modification", "ever_modified", "ever_forbearance", "forbearance_months"],
    "risk": ["credit_risk_score", "debt_burden", "equity_cushion", "loan_age_risk", "is_seasoned", "high_ltv_flag", "subprime_flag", "high_dti_flag"],
    "interaction": ["credit_x_ltv", "dti_x_rate", "credit_x_dti", "dlqhist_x_ltv", "amortgap_x_rate"],
}


def names(family: str | None = None) -> list[str]:
    return [n for f, own in NAMES.items() if family in (None, f) for n in own]


BANNED = ("loan_id", "reporting_month", "ingest_seq", "month_index", "dq_penalty", "dq_score", "n_hard_failures", "n_soft_failures", "months_to_data_end", "split", "source_file")


def model_inputs(df: DataFrame) -> list[str]:
    """Numeric and boolean columns that a model may see: no keys, scores, labels, rules or evidence."""
    kinds = ("int", "bigint", "double", "float", "smallint", "tinyint", "boolean")
    labels = (*C.HORIZONS, *(f"{h}_complete" for h in C.HORIZONS), "next_state_complete", "next_12m_default_ex_forbearance", "next_12m_default_credit_event")
    return [c for c, t in df.dtypes if t in kinds and c not in BANNED and c not in labels and c not in C.RULES and not c.startswith("_")]


def leakage_audit(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of rows where a feature equals its own next month's value; above 99.9 % is suspicious."""
    w = Window.partitionBy("loan_id").orderBy("reporting_month")
    pairs = df.select(*[F.struct(F.col(c).cast("double").alias("a"), F.lead(F.col(c).cast("double")).over(w).alias("b")).alias(c) for c in columns])
    one = pairs.agg(*[F.struct(F.count_if(F.col(f"{c}.a") == F.col(f"{c}.b")).alias("same"), F.count_if((F.col(f"{c}.a") - F.col(f"{c}.b")).isNotNull()).alias("n")).alias(c) for c in columns])
    long = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}.same").alias("n_same"), F.col(f"{c}.n").alias("n_pairs")) for c in columns])))
    share = S.ratio(F.col("n_same").cast("double"), F.col("n_pairs").cast("double"))
    return long.select("feature", "n_same", "n_pairs", share.alias("same_share"), S.truth(share > 0.999).alias("suspicious"))
