"""The input contract: raw layout, code maps, bands, thresholds, rules and scenarios."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

SCHEMA_VERSION, FEATURE_VERSION, CONFIG_VERSION = "raw_113col_v1", "features_v1", "config_v1"


class Field(NamedTuple):
    name: str
    kind: str
    dtype: str
    parsed: bool


# The raw record's 113 positional fields (name, kind, type, parsed or not), in order.
_LAYOUT = """
POOL_ID unused string no
LOAN_ID identifier string yes
ACT_PERIOD time MMYYYY yes
CHANNEL acquisition category yes
SELLER acquisition string yes
SERVICER performance string yes
MASTER_SERVICER unused string no
ORIG_RATE acquisition float yes
CURR_RATE performance float yes
ORIG_UPB acquisition float yes
ISSUANCE_UPB unused float no
CURRENT_UPB performance float yes
ORIG_TERM acquisition int yes
ORIG_DATE time MMYYYY yes
FIRST_PAY time MMYYYY no
LOAN_AGE time int yes
REM_MONTHS time int yes
ADJ_REM_MONTHS time int no
MATR_DT time MMYYYY yes
OLTV acquisition float yes
OCLTV acquisition float yes
NUM_BO acquisition int yes
DTI acquisition float yes
CSCORE_B acquisition float yes
CSCORE_C acquisition float yes
FIRST_FLAG acquisition category yes
PURPOSE acquisition category yes
PROP acquisition category yes
NO_UNITS acquisition int yes
OCC_STAT acquisition category yes
STATE acquisition category yes
MSA acquisition category yes
ZIP acquisition category yes
MI_PCT acquisition float yes
PRODUCT acquisition category yes
PPMT_FLG acquisition category no
IO acquisition category no
FIRST_PAY_IO unused MMYYYY no
MNTHS_TO_AMTZ_IO unused int no
DLQ_STATUS performance category yes
PMT_HISTORY performance string no
MOD_FLAG performance category yes
MI_CANCEL_FLAG unused category no
Zero_Bal_Code credit_event category yes
ZB_DTE credit_event MMYYYY yes
LAST_UPB credit_event float yes
RPRCH_DTE unused MMYYYY no
CURR_SCHD_PRNCPL unused float no
TOT_SCHD_PRNCPL performance float yes
UNSCHD_PRNCPL_CURR unused float no
LAST_PAID_INSTALLMENT_DATE performance MMYYYY yes
FORECLOSURE_DATE credit_event MMYYYY no
DISPOSITION_DATE credit_event MMYYYY no
FORECLOSURE_COSTS credit_event float no
PROPERTY_PRESERVATION_AND_REPAIR_COSTS credit_event float no
ASSET_RECOVERY_COSTS credit_event float no
MISCELLANEOUS_HOLDING_EXPENSES_AND_CREDITS credit_event float no
ASSOCIATED_TAXES_FOR_HOLDING_PROPERTY credit_event float no
NET_SALES_PROCEEDS credit_event float no
CREDIT_ENHANCEMENT_PROCEEDS credit_event float no
REPURCHASES_MAKE_WHOLE_PROCEEDS credit_event float no
OTHER_FORECLOSURE_PROCEEDS credit_event float no
NON_INTEREST_BEARING_UPB performance float yes
PRINCIPAL_FORGIVENESS_AMOUNT performance float yes
ORIGINAL_LIST_START_DATE unused MMYYYY no
ORIGINAL_LIST_PRICE unused float no
CURRENT_LIST_START_DATE unused MMYYYY no
CURRENT_LIST_PRICE unused float no
ISSUE_SCOREB unused float no
ISSUE_SCOREC unused float no
CURR_SCOREB unused float no
CURR_SCOREC unused float no
MI_TYPE acquisition category yes
SERV_IND performance category yes
CURRENT_PERIOD_MODIFICATION_LOSS_AMOUNT unused float no
CUMULATIVE_MODIFICATION_LOSS_AMOUNT unused float no
CURRENT_PERIOD_CREDIT_EVENT_NET_GAIN_OR_LOSS unused float no
CUMULATIVE_CREDIT_EVENT_NET_GAIN_OR_LOSS unused float no
HOMEREADY_PROGRAM_INDICATOR acquisition category yes
FORECLOSURE_PRINCIPAL_WRITE_OFF_AMOUNT credit_event float no
RELOCATION_MORTGAGE_INDICATOR acquisition category no
ZERO_BALANCE_CODE_CHANGE_DATE unused MMYYYY no
LOAN_HOLDBACK_INDICATOR unused category no
LOAN_HOLDBACK_EFFECTIVE_DATE unused MMYYYY no
DELINQUENT_ACCRUED_INTEREST unused float no
PROPERTY_INSPECTION_WAIVER_INDICATOR acquisition category no
HIGH_BALANCE_LOAN_INDICATOR acquisition category yes
ARM_5_YR_INDICATOR unused category no
ARM_PRODUCT_TYPE unused category no
MONTHS_UNTIL_FIRST_PAYMENT_RESET unused int no
MONTHS_BETWEEN_SUBSEQUENT_PAYMENT_RESET unused int no
INTEREST_RATE_CHANGE_DATE unused MMYYYY no
PAYMENT_CHANGE_DATE unused MMYYYY no
ARM_INDEX unused category no
ARM_CAP_STRUCTURE unused category no
INITIAL_INTEREST_RATE_CAP unused float no
PERIODIC_INTEREST_RATE_CAP unused float no
LIFETIME_INTEREST_RATE_CAP unused float no
MARGIN unused float no
BALLOON_INDICATOR unused category no
PLAN_NUMBER unused category no
FORBEARANCE_INDICATOR performance category yes
HIGH_LOAN_TO_VALUE_HLTV_REFINANCE_OPTION_INDICATOR acquisition category no
DEAL_NAME unused string no
RE_PROCS_FLAG credit_event category no
ADR_TYPE performance category yes
ADR_COUNT performance int no
ADR_UPB performance float no
PAYMENT_DEFERRAL_MOD_EVENT_FLAG performance category no
INTEREST_BEARING_UPB unused float no
UNVERIFIED_110 unused float no
UNVERIFIED_111 unused string no
UNVERIFIED_112 unused string no
"""
LAYOUT = tuple(Field(n, k, t, p == "yes") for n, k, t, p in (x.split() for x in _LAYOUT.strip().splitlines()))
PARSED = tuple(f.name for f in LAYOUT if f.parsed)
if len(LAYOUT) != 113:
    raise AssertionError("the raw layout has 113 fields")


def raw_schema() -> T.StructType:
    """All fields as nullable strings, with kind and type as metadata."""
    return T.StructType([T.StructField(f.name, T.StringType(), True, {"kind": f.kind, "dtype": f.dtype, "parsed": f.parsed}) for f in LAYOUT])


UNKNOWN = "Unknown"
# Codes of the raw record and their names.
PURPOSE = {"P": "purchase", "C": "cash_out_refinance", "R": "refinance", "U": "Unknown"}
PROPERTY = {"SF": "single_family", "PU": "planned_urban_development", "CO": "condominium", "CP": "cooperative", "MH": "manufactured_home"}
OCCUPANCY = {"P": "principal", "I": "investor", "S": "second_home", "U": "Unknown"}
CHANNEL = {"R": "retail", "C": "correspondent", "B": "broker"}
MI_TYPE = {"1": "borrower_paid", "2": "lender_paid", "3": "investor_paid"}
ZERO_BALANCE = {
    "01": "prepaid_or_matured", "02": "third_party_sale", "03": "short_sale", "06": "repurchased",
    "09": "deed_in_lieu_reo", "15": "note_sale", "16": "reperforming_loan_sale",
}
PREPAID, CREDIT_EVENT = ("01",), ("02", "03", "09", "15")
STATES = ("Current", "Delinquent", "Default", "Prepaid", "Closed")

# Band edges (left closed, right open) and labels.
CREDIT_BANDS = (0, 580, 620, 660, 680, 700, 720, 740, 760, 780, 851), (
    "<580", "580-619", "620-659", "660-679", "680-699", "700-719", "720-739", "740-759", "760-779", "780+")
LTV_BANDS = (0, 60, 70, 80, 85, 90, 95, 97, 1000), ("<60", "60-70", "70-80", "80-85", "85-90", "90-95", "95-97", "97+")
DTI_BANDS = (0, 20, 28, 36, 43, 50, 1000), ("<20", "20-28", "28-36", "36-43", "43-50", "50+")

# Thresholds of the domain, in months unless named otherwise.
DELINQUENT_MONTHS, DEFAULT_MONTHS, DEFAULT_MONTHS_ALT = 1, 6, 3
STALE_MONTHS, FLAPS, DROP_PCT = 6, 3, 40.0
ROLLING = (3, 6, 12)
HORIZONS = {
    "next_3m_delinquency_flag": (3, "delinquency"), "next_6m_delinquency_flag": (6, "delinquency"),
    "next_12m_default_flag": (12, "default_flag"), "next_12m_prepayment_flag": (12, "prepayment_flag"),
}
RISK_LEVELS = (0.02, 0.10, 0.25), ("low", "medium", "high", "critical")
PSI_LEVELS = (0.10, 0.25), ("stable", "moderate", "significant")


class RuleText(NamedTuple):
    exception_type: str
    severity: str
    weight: float
    description: str


# The rule catalogue.
RULES = {
    "R001": RuleText("balance_inconsistency", "hard", 25.0, "current_balance exceeds original_balance, which is impossible under standard amortisation without a documented modification"),
    "R002": RuleText("balance_increase", "soft", 15.0, "current_balance increased month-over-month without a modification flag"),
    "R003": RuleText("date_conflict", "hard", 25.0, "reporting_month precedes origination_month"),
    "R004": RuleText("delinquency_status_mismatch", "hard", 20.0, "days_past_due is zero while current_status is Delinquent, or non-zero while status is Current"),
    "R005": RuleText("negative_value", "hard", 25.0, "a balance or term field is negative"),
    "R006": RuleText("stale_update", "soft", 10.0, "the loan's reported balance has not changed for 6 or more consecutive months while the loan is active and interest-bearing"),
    "R007": RuleText("status_flapping", "soft", 10.0, "the loan alternated between Current and Delinquent three or more times within a rolling 12-month window"),
    "R008": RuleText("missing_status", "soft", 8.0, "the servicer did not report a delinquency status (DLQ_STATUS = 'XX' or blank) on an active loan"),
    "R009": RuleText("impossible_term", "hard", 20.0, "remaining_term_months exceeds the original loan term"),
    "R010": RuleText("post_termination_activity", "hard", 25.0, "a performance record exists for a month after the loan reached a terminal zero-balance state"),
    "R011": RuleText("amortisation_anomaly", "soft", 12.0, "the balance fell by more than 40% in a single month without the loan terminating, which is inconsistent with scheduled amortisation"),
    "R012": RuleText("source_conflict", "soft", 18.0, "the secondary servicer feed reports a different status or balance than the primary performance record for the same loan-month"),
    "R013": RuleText("document_gap", "soft", 10.0, "a month is missing from the loan's otherwise continuous monthly reporting sequence"),
}
PRIORITY = tuple(sorted(RULES, key=lambda r: -RULES[r].weight))

# Scenario parameters by name.
SCENARIO_COLUMNS = (
    "scenario_name", "unemployment_shift_bps", "hpi_shock_pct", "rate_shift_bps", "delinquency_multiplier", "default_multiplier",
    "prepayment_multiplier", "dpd_stress_months", "ltv_stress_pct")
SCENARIOS = (
    ("base", 0, 0.0, 0, 1.0, 1.0, 1.0, 0.0, 0.0),
    ("adverse_credit", 300, -15.0, 100, 2.1, 2.6, 0.65, 1.0, 15.0),
    ("high_prepayment", -50, 6.0, -150, 0.85, 0.75, 2.4, 0.0, -6.0),
)
