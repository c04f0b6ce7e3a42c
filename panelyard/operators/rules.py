"""Thirteen data-quality rules as columns, their scores and readable reasons."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelyard.functions import scalar as S
from panelyard.functions.windows import by_entity, to_date, trailing
from panelyard.plans import contract as C

HARD = [r for r, t in C.RULES.items() if t.severity == "hard"]
SOFT = [r for r, t in C.RULES.items() if t.severity == "soft"]


def evidence(panel: DataFrame) -> DataFrame:
    """What the rules look at besides the row itself: changes, runs, transitions and gaps.

    Needs the panel with the dimension's columns.  All windows share the entity's exchange.
    """
    w = by_entity()
    previous = F.lag("current_balance").over(w)
    rows = panel.withColumn("_balance_delta", F.col("current_balance") - previous).withColumn("_balance_drop_pct", S.ratio(previous - F.col("current_balance"), previous) * 100)
    same = S.flag(F.abs("_balance_delta") < 0.01)
    rows = rows.withColumn("_same", same).withColumn("_block", F.sum(1 - F.col("_same")).over(to_date()))
    rows = rows.withColumn("_stale_months", F.sum("_same").over(to_date(Window.partitionBy("loan_id", "_block").orderBy("reporting_month"))).cast("int"))
    changed = S.flag(F.col("current_status") != F.lag("current_status").over(w))
    rows = rows.withColumn("_changed", changed).withColumn("_n_transitions", F.sum("_changed").over(trailing(12)).cast("int"))
    gap = S.month_number(F.col("reporting_month")) - S.month_number(F.lag("reporting_month").over(w))
    return rows.select(
        *panel.columns, "_balance_delta", "_balance_drop_pct", "_stale_months", "_n_transitions", gap.cast("int").alias("_gap_months"),
        F.min("zero_balance_date").over(Window.partitionBy("loan_id")).alias("_first_end"))


def with_feed(panel: DataFrame, feed: DataFrame | None) -> DataFrame:
    """The feed's status for the same entity and month, one row each."""
    if feed is None:
        return panel.withColumn("conflict_status", F.lit(None).cast("string"))
    one = feed.groupBy("loan_id", "reporting_month").agg(F.min("feed_status").alias("conflict_status"))
    return panel.join(one, ["loan_id", "reporting_month"], "left")


def predicates(columns: list[str]) -> dict[str, Column]:
    """Rule id to condition over a panel with evidence; a rule without its columns never fires."""
    c = F.col
    alive, changed = ~c("is_terminated"), c("modification_flag")
    own = {
        "R001": (c("current_balance") > c("original_balance") * 1.0001) & ~changed,
        "R002": (c("_balance_delta") > 1.0) & ~changed & alive,
        "R003": c("reporting_month") < c("origination_month"),
        "R004": ((c("current_status") == "Delinquent") & (c("days_past_due") <= 0)) | ((c("current_status") == "Current") & (c("days_past_due") > 0)),
        "R005": (c("current_balance") < 0) | (c("remaining_term_months") < 0),
        "R006": (c("_stale_months") >= C.STALE_MONTHS) & alive,
        "R007": c("_n_transitions") >= C.FLAPS,
        "R008": c("dlq_status_unreported") & alive,
        "R009": c("remaining_term_months") > c("original_term_months"),
        "R010": c("reporting_month") > c("_first_end"),
        "R011": (c("_balance_drop_pct") > C.DROP_PCT) & alive,
        "R012": c("conflict_status") != c("current_status"),
        "R013": c("_gap_months") > 1,
    }
    needs = {"R003": "origination_month", "R009": "original_term_months", "R001": "original_balance", "R012": "conflict_status", "R008": "dlq_status_unreported"}
    return {r: S.truth(p) if needs.get(r, "loan_id") in columns else F.lit(False) for r, p in own.items()}


def _reasons() -> dict[str, Column]:
    c = F.col
    money = lambda x: F.format_number(F.coalesce(x, F.lit(0.0)), 2)
    whole = lambda x: F.coalesce(x, F.lit(0)).cast("long").cast("string")
    month = lambda x: F.date_format(x, "yyyy-MM")
    return {
        "R001": F.concat(F.lit("current_balance "), money(c("current_balance")), F.lit(" exceeds original_balance "), money(c("original_balance")), F.lit(" with no modification_flag")),
        "R002": F.concat(F.lit("current_balance rose by "), money(c("_balance_delta")), F.lit(" versus the prior month without a modification_flag")),
        "R003": F.concat(F.lit("reporting_month "), month(c("reporting_month")), F.lit(" precedes origination "), month(c("origination_month"))),
        "R004": F.concat(F.lit("current_status '"), c("current_status"), F.lit("' is inconsistent with days_past_due "), whole(c("days_past_due"))),
        "R005": F.concat(F.lit("negative value detected: current_balance="), money(c("current_balance")), F.lit(", remaining_term_months="), whole(c("remaining_term_months"))),
        "R006": F.concat(F.lit("balance unchanged for "), whole(c("_stale_months")), F.lit(" consecutive months while status is '"), c("current_status"), F.lit("'")),
        "R007": F.concat(F.lit("status changed "), whole(c("_n_transitions")), F.lit(" times in the trailing 12 months, indicating unstable servicer reporting")),
        "R008": F.lit("delinquency status was not reported by the servicer for this month"),
        "R009": F.concat(F.lit("remaining_term_months "), whole(c("remaining_term_months")), F.lit(" exceeds original_term_months "), whole(c("original_term_months"))),
        "R010": F.concat(F.lit("record dated "), month(c("reporting_month")), F.lit(" occurs after the loan reached a terminal zero-balance state")),
        "R011": F.concat(F.lit("balance fell by "), F.format_string("%.1f", F.coalesce("_balance_drop_pct", F.lit(0.0))), F.lit("% in one month without a zero-balance termination")),
        "R012": F.concat(F.lit("servicer_updates reports status '"), c("conflict_status"), F.lit("' versus primary '"), c("current_status"), F.lit("'")),
        "R013": F.concat(F.lit("gap of "), whole(c("_gap_months")), F.lit(" months detected in the monthly reporting sequence")),
    }


def apply_rules(panel: DataFrame, feed: DataFrame | None = None) -> DataFrame:
    """The panel with R001 ... R013, dq_penalty, dq_score, failure counts, exception_type and reason.

    The exception is that of the heaviest rule that fired, ties in catalogue order.
    """
    rows = evidence(with_feed(panel, feed))
    rows = rows.select("*", *[p.alias(r) for r, p in predicates(rows.columns).items()])
    penalty = sum((F.col(r).cast("int") * t.weight for r, t in C.RULES.items()), F.lit(0.0))
    fired = lambda rules: sum((F.col(r).cast("int") for r in rules), F.lit(0))
    reasons = _reasons()
    return rows.select(
        "*", penalty.alias("dq_penalty"), F.greatest(100.0 - penalty, F.lit(0.0)).alias("dq_score"), fired(HARD).alias("n_hard_failures"), fired(SOFT).alias("n_soft_failures"),
        F.coalesce(*[F.when(F.col(r), C.RULES[r].exception_type) for r in C.PRIORITY]).alias("exception_type"),
        F.coalesce(*[F.when(F.col(r), F.coalesce(reasons[r], F.lit(C.RULES[r].description))) for r in C.PRIORITY]).alias("reason"))


def batch_summary(ruled: DataFrame) -> DataFrame:
    """One row on the whole batch."""
    share = lambda p: F.avg(p.cast("int").cast("double")) * 100
    hard, any_ = F.col("n_hard_failures") > 0, F.col("dq_penalty") > 0
    return ruled.agg(
        F.count("*").alias("n_records"), F.avg("dq_score").alias("batch_dq_score"), F.count_if(any_).alias("records_with_any_failure"),
        F.count_if(hard).alias("records_with_hard_failure"), share(hard).alias("pct_with_hard_failure"))


def rule_summary(ruled: DataFrame) -> DataFrame:
    """Per rule: type, severity, failures and their share; one aggregation, then turned long."""
    one = ruled.agg(F.count("*").alias("_n"), *[F.count_if(F.col(r)).alias(r) for r in C.RULES])
    rows = F.array(*[F.struct(F.lit(r).alias("rule_id"), F.lit(t.exception_type).alias("exception_type"), F.lit(t.severity).alias("severity"), F.col(r).alias("n_failed")) for r, t in C.RULES.items()])
    return one.select("_n", F.inline(rows)).select("rule_id", "exception_type", "severity", "n_failed", S.ratio(F.col("n_failed") * 100.0, F.col("_n").cast("double")).alias("pct_failed"))


def exception_pairs(ruled: DataFrame) -> DataFrame:
    """How often two rules fire on the same row: support, and lift over independence."""
    fired = F.filter(F.array(*[F.when(F.col(r), F.lit(r)) for r in C.RULES]), lambda x: x.isNotNull())
    counts = ruled.agg(F.count("*").alias("_n"), *[F.count_if(F.col(a) & F.col(b)).alias(f"{a}_{b}") for i, a in enumerate(C.RULES) for b in list(C.RULES)[i:]])
    names = list(C.RULES)
    rows = F.array(*[F.struct(F.lit(a).alias("rule_a"), F.lit(b).alias("rule_b"), F.col(f"{a}_{b}").alias("n_both"), F.col(f"{a}_{a}").alias("_a"), F.col(f"{b}_{b}").alias("_b"))
                     for i, a in enumerate(names) for b in names[i + 1:]])
    del fired
    lift = S.ratio(F.col("n_both").cast("double") * F.col("_n"), F.col("_a").cast("double") * F.col("_b"))
    return counts.select("_n", F.inline(rows)).filter("n_both > 0").select("rule_a", "rule_b", "n_both", S.ratio(F.col("n_both").cast("double"), F.col("_n").cast("double")).alias("support"), lift.alias("lift"))


def catalogue() -> str:
    """The rule catalogue as JSON."""
    return json.dumps({
        "_meta": {"version": C.CONFIG_VERSION},
        "thresholds": {"delinquent_months": C.DELINQUENT_MONTHS, "default_months": C.DEFAULT_MONTHS, "stale_months": C.STALE_MONTHS, "flaps": C.FLAPS, "drop_pct": C.DROP_PCT},
        "rules": [{"id": r, **t._asdict()} for r, t in C.RULES.items()]}, indent=1)


def read_catalogue(text: str) -> dict[str, C.RuleText]:
    return {r.pop("id"): C.RuleText(**r) for r in json.loads(text)["rules"]}
