"""Raw string records to the canonical panel, the dimension and population aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelyard.functions import scalar as S
from panelyard.operators.ordered import numbered
from panelyard.plans import contract as C

RAW_CARRIED = ("source_file", "ingest_seq")


def _carried(raw: DataFrame) -> list[str]:
    return [c for c in RAW_CARRIED if c in raw.columns]


def monthly(raw: DataFrame, default_months: int = C.DEFAULT_MONTHS) -> DataFrame:
    """One canonical row for each raw record: typed values, status and flags.  A projection, no shuffle."""
    c = F.col
    months = S.delinquency_months(c("DLQ_STATUS"))
    forborne = S.truth(~F.trim(c("FORBEARANCE_INDICATOR")).isin("", "N", "7"))
    code = F.trim(c("Zero_Bal_Code"))
    credit = S.truth(code.isin(*C.CREDIT_EVENT))
    deep = S.truth(months >= default_months)
    return raw.select(
        F.trim("LOAN_ID").alias("loan_id"), S.parse_month(c("ACT_PERIOD")).alias("reporting_month"),
        S.to_number(c("CURRENT_UPB")).alias("current_balance"), S.to_number(c("CURR_RATE")).alias("current_interest_rate"),
        S.to_int(c("LOAN_AGE")).alias("loan_age_months"), S.to_int(c("REM_MONTHS")).alias("remaining_term_months"),
        S.to_number(c("TOT_SCHD_PRNCPL")).alias("scheduled_principal"), S.to_number(c("NON_INTEREST_BEARING_UPB")).alias("non_interest_bearing_upb"),
        S.to_number(c("PRINCIPAL_FORGIVENESS_AMOUNT")).alias("principal_forgiveness"), S.to_number(c("LAST_UPB")).alias("last_upb"),
        months.alias("dlq_months"), (months * 30).cast("double").alias("days_past_due"),
        *[v.alias(k) for k, v in S.status(months, c("Zero_Bal_Code"), default_months).items()],
        F.when(code != "", code).alias("zero_balance_code"), S.parse_month(c("ZB_DTE")).alias("zero_balance_date"),
        S.parse_month(c("LAST_PAID_INSTALLMENT_DATE")).alias("last_paid_installment"), S.equals(c("MOD_FLAG"), "Y").alias("modification_flag"),
        forborne.alias("forbearance_flag"), S.clean_category(c("SERVICER")).alias("servicer_name"), credit.alias("default_flag_credit_event"),
        (credit | (deep & ~forborne)).alias("default_flag_ex_forbearance"), *_carried(raw))


STATIC = (
    "LOAN_ID", "ORIG_UPB", "ORIG_RATE", "ORIG_TERM", "CSCORE_B", "CSCORE_C", "OLTV", "OCLTV", "DTI", "ORIG_DATE", "STATE", "PURPOSE", "PROP", "OCC_STAT",
    "CHANNEL", "MI_TYPE", "SELLER", "NUM_BO", "NO_UNITS", "MSA", "ZIP", "MI_PCT", "PRODUCT", "FIRST_FLAG", "HOMEREADY_PROGRAM_INDICATOR", "HIGH_BALANCE_LOAN_INDICATOR")


def first_per_entity(raw: DataFrame, key: str = "LOAN_ID", order: str = "ingest_seq") -> DataFrame:
    """The first record of each entity, combined before the shuffle."""
    rest = [c for c in raw.columns if c != key]
    return raw.groupBy(key).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r")).select(key, *[F.col(f"_r.`{c}`").alias(c) for c in rest])


def static(raw: DataFrame) -> DataFrame:
    """The dimension: one row for each entity, bands beside the continuous values."""
    c = F.col
    one = first_per_entity(raw.select(*STATIC, *_carried(raw)))
    score, ltv, dti = S.to_number(c("CSCORE_B")), S.to_number(c("OLTV")), S.to_number(c("DTI"))
    start = S.parse_month(c("ORIG_DATE"))
    return one.select(
        F.trim("LOAN_ID").alias("loan_id"), S.to_number(c("ORIG_UPB")).alias("original_balance"), S.to_number(c("ORIG_RATE")).alias("interest_rate"),
        S.to_int(c("ORIG_TERM")).alias("original_term_months"), score.alias("credit_score"), S.to_number(c("CSCORE_C")).alias("co_borrower_credit_score"),
        ltv.alias("ltv"), S.to_number(c("OCLTV")).alias("combined_ltv"), dti.alias("dti"), S.band(score, C.CREDIT_BANDS).alias("credit_score_band"),
        S.band(ltv, C.LTV_BANDS).alias("ltv_band"), S.band(dti, C.DTI_BANDS).alias("dti_band"), start.alias("origination_month"),
        S.clean_category(c("STATE")).alias("state"), S.decode(c("PURPOSE"), C.PURPOSE).alias("loan_purpose"), S.decode(c("PROP"), C.PROPERTY).alias("property_type"),
        S.decode(c("OCC_STAT"), C.OCCUPANCY).alias("occupancy_type"), S.decode(c("CHANNEL"), C.CHANNEL).alias("channel"), S.decode(c("MI_TYPE"), C.MI_TYPE).alias("mi_type"),
        S.clean_category(c("SELLER")).alias("seller_name"), S.to_int(c("NUM_BO")).alias("num_borrowers"), S.to_int(c("NO_UNITS")).alias("num_units"),
        S.clean_category(c("MSA")).alias("msa"), S.clean_category(c("ZIP")).alias("zip3"), S.to_number(c("MI_PCT")).alias("mi_pct"),
        S.clean_category(c("PRODUCT")).alias("product_type"), S.equals(c("FIRST_FLAG"), "Y").alias("first_time_buyer"),
        S.equals(c("HOMEREADY_PROGRAM_INDICATOR"), "H").alias("homeready_flag"), S.equals(c("HIGH_BALANCE_LOAN_INDICATOR"), "Y").alias("high_balance_flag"),
        F.year(start).alias("vintage_year"), F.quarter(start).alias("vintage_quarter"), *[x for x in _carried(raw) if x == "source_file"])


def with_month_index(panel: DataFrame) -> DataFrame:
    """Rows of an entity numbered from 0 in month order."""
    return panel.withColumn("month_index", F.row_number().over(Window.partitionBy("loan_id").orderBy("reporting_month")) - 1)


def light(raw: DataFrame) -> DataFrame:
    """The few columns that the pass over all records needs; the month stays text until it is aggregated."""
    months, code = S.delinquency_months(F.col("DLQ_STATUS")), F.col("Zero_Bal_Code")
    late, credit = S.truth(months >= C.DELINQUENT_MONTHS), code.isin(*C.CREDIT_EVENT)
    return raw.select(
        "LOAN_ID", "ACT_PERIOD", S.to_number(F.col("CURRENT_UPB")).alias("current_balance"), months.alias("dlq_months"), late.alias("delinquency"),
        S.truth(months >= C.DEFAULT_MONTHS_ALT).alias("is_d90"), (S.truth(months >= C.DEFAULT_MONTHS) | credit).alias("default_flag"),
        code.isin(*C.PREPAID).alias("prepayment_flag"), (code != "").alias("is_terminated"), months.isNull().alias("dlq_unknown"), *_carried(raw))


def _counts() -> list[Column]:
    names = {"n_delinquent": "delinquency", "n_d90": "is_d90", "n_default": "default_flag", "n_prepaid": "prepayment_flag", "n_terminated": "is_terminated", "n_dlq_unknown": "dlq_unknown"}
    return [
        F.count("*").alias("n_records"), F.coalesce(F.sum(F.col("current_balance").cast("decimal(20,2)")), F.lit(0)).cast("double").alias("sum_balance"),
        *[F.count_if(F.col(c)).alias(n) for n, c in names.items()], F.coalesce(F.sum("dlq_months"), F.lit(0)).alias("sum_dlq_months")]


def _rates(df: DataFrame) -> DataFrame:
    rates = {"delinquency_rate": "n_delinquent", "default_rate": "n_default", "prepayment_rate": "n_prepaid", "d90_rate": "n_d90", "unknown_rate": "n_dlq_unknown"}
    return df.select("*", *[S.ratio(F.col(n).cast("double"), F.col("n_records").cast("double")).alias(r) for r, n in rates.items()])


def population(raw: DataFrame) -> DataFrame:
    """Aggregates and rates of all records by month."""
    by = light(raw).groupBy("ACT_PERIOD").agg(*_counts())
    return _rates(by).select(S.parse_month(F.col("ACT_PERIOD")).alias("reporting_month"), *[c for c in _rates(by).columns if c != "ACT_PERIOD"])


def population_by_vintage(raw: DataFrame) -> DataFrame:
    """By month and source file, with the months' totals (source_file null), in one pass."""
    names = [c for c in light(raw).columns if c not in ("ACT_PERIOD", "source_file")]
    by = light(raw).select("ACT_PERIOD", "source_file", *names).groupingSets([["ACT_PERIOD"], ["ACT_PERIOD", "source_file"]], "ACT_PERIOD", "source_file").agg(*_counts())
    return _rates(by).withColumn("reporting_month", S.parse_month(F.col("ACT_PERIOD"))).drop("ACT_PERIOD")


def sample_audit(raw: DataFrame, rate: float, salt: str) -> DataFrame:
    """Rates of rows and entities that a sample takes, against its target."""
    kept = S.sampled(F.col("LOAN_ID"), rate, salt)
    per = raw.groupBy("LOAN_ID").agg(F.count("*").alias("n")).withColumn("kept", kept)
    return per.agg(
        F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(F.col("kept"), F.col("n"))), F.lit(0).cast("long")).alias("n_rows_kept"), F.count("*").alias("n_entities"),
        F.count_if(F.col("kept")).alias("n_entities_kept"), F.lit(float(rate)).alias("target_rate")).select(
        "*", S.ratio(F.col("n_rows_kept").cast("double"), F.col("n_rows").cast("double")).alias("row_rate"),
        S.ratio(F.col("n_entities_kept").cast("double"), F.col("n_entities").cast("double")).alias("entity_rate"))


def stride_sample(df: DataFrame, order: list[str], every: int, by: str | None = None) -> DataFrame:
    """Every ``every``-th row in an explicit order, inside each ``by`` group or over the whole table."""
    if by is None:
        rows = numbered(df, order, "_n")
    else:
        rows = df.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(*order)) - 1)
    return rows.filter(F.col("_n") % every == 0).drop("_n")


def seeded_cap(df: DataFrame, key: list[str], n: int, seed: int = 42) -> DataFrame:
    """``n`` rows by the order of a seeded hash of their key; the same on every run."""
    return df.orderBy(F.xxhash64(F.lit(seed), *key), *key).limit(n)
