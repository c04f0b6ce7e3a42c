import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from panelyard.operators import clean, features, ingest, labels, rules
from panelyard.plans import contract as C
from panelyard.plans import panel as P


def month(n):
    return dt.date(2018 + n // 12, n % 12 + 1, 1)


BASE = {
    "current_interest_rate": 4.0, "remaining_term_months": 300, "scheduled_principal": 1.0, "non_interest_bearing_upb": 0.0, "last_upb": None, "termination_reason": None, "zero_balance_date": None,
    "modification_flag": False, "forbearance_flag": False, "servicer_name": "s", "default_flag_credit_event": False, "default_flag_ex_forbearance": False, "prepayment_flag": False}
SCHEMA = (
    "loan_id string, reporting_month date, current_balance double, dlq_months int, days_past_due double, current_status string, delinquency boolean, default_flag boolean, is_terminated boolean, loan_age_months int, ingest_seq long, "
    "current_interest_rate double, remaining_term_months int, scheduled_principal double, non_interest_bearing_upb double, last_upb double, termination_reason string, zero_balance_date date, modification_flag boolean, forbearance_flag boolean, "
    "servicer_name string, default_flag_credit_event boolean, default_flag_ex_forbearance boolean, prepayment_flag boolean")


def rows(spark, specs):
    out = []
    for i, s in enumerate(specs):
        m = s.get("dlq_months", 0)
        row = BASE | {"loan_id": "a", "current_balance": 100.0 - i, "dlq_months": m, "days_past_due": None if m is None else 30.0 * m, "current_status": "Delinquent" if m else "Current", "delinquency": bool(m),
                      "default_flag": (m or 0) >= 6, "is_terminated": False, "loan_age_months": i, "ingest_seq": i, "reporting_month": month(i)} | s
        out.append(tuple(row[c.split()[0]] for c in SCHEMA.split(", ")))
    return spark.createDataFrame(out, SCHEMA)


def static(spark, ids=("a", "b"), balance=100.0):
    return spark.createDataFrame([(i, balance, 4.0, 360, 700.0, 80.0, 30.0, dt.date(2017, 12, 1)) for i in ids],
                                 "loan_id string, original_balance double, interest_rate double, original_term_months int, credit_score double, ltv double, dti double, origination_month date")


def panel(spark, specs):
    fixed = clean.clean_panel(rows(spark, specs))[0]
    return ingest.with_month_index(fixed.join(static(spark), "loan_id", "left"))


def fired(spark, specs, feed=None):
    out = rules.apply_rules(panel(spark, specs), feed).orderBy("loan_id", "reporting_month").collect()
    return [[r for r in C.RULES if x[r]] for x in out], out


def test_deduplicate(spark):
    df = rows(spark, [{}, {"current_balance": 100.0, "reporting_month": month(0), "loan_age_months": 0}, {"reporting_month": month(0)}, {"loan_id": None}, {"reporting_month": None}, {"loan_id": ""}])
    kept, out = clean.deduplicate(df)
    assert sorted((r.loan_id, r.ingest_seq) for r in kept.collect()) == [("", 5), ("a", 0)]
    assert sorted((r.ingest_seq, r.quarantine_reason) for r in out.collect()) == [
        (0, "conflicting_duplicate_loan_month"), (2, "conflicting_duplicate_loan_month"), (3, "missing_primary_key"), (4, "missing_primary_key")]
    seen = {r.ingest_seq for r in kept.union(out.drop("quarantine_reason")).collect()}
    assert seen == {0, 2, 3, 4, 5}


def test_repair(spark):
    got = clean.clean_panel(rows(spark, [{"current_balance": 0.0}, {"current_balance": None}, {"current_balance": 90.0, "dlq_months": None}, {"current_balance": -1.0}, {"current_balance": 0.0, "is_terminated": True}, {"loan_id": "b", "current_balance": None}]))[0]
    r = got.orderBy("loan_id", "reporting_month").collect()
    assert [x.current_balance for x in r] == [90.0, 90.0, 90.0, 90.0, 0.0, None]
    assert [x.balance_imputed for x in r] == [True, True, False, True, False, True]
    assert r[2].dlq_status_unreported and r[2].dlq_months == 0 and r[2].days_past_due == 0 and r[5].balance_unrecoverable


def test_rules(spark):
    hit, out = fired(spark, [
        {"current_balance": 101.0}, {"current_balance": 99.0, "dlq_months": None}, {"current_balance": 50.0}, {"current_balance": 52.0, "remaining_term_months": 361}, {"current_balance": 51.0, "reporting_month": month(5)},
        {"loan_id": "b", "reporting_month": dt.date(2017, 11, 1), "current_balance": 60.0}, {"loan_id": "b", "current_balance": 59.0, "current_status": "Delinquent"}, {"loan_id": "b", "current_balance": 58.0, "days_past_due": 30.0}])
    assert hit == [["R001"], ["R008"], ["R011"], ["R002", "R009"], ["R013"], ["R003"], ["R004", "R013"], ["R004"]]
    assert out[0].dq_penalty == 25 and out[0].dq_score == 75 and out[3].exception_type == "impossible_term" and out[3].n_hard_failures == 1 and out[3].n_soft_failures == 1
    assert out[0].reason == "current_balance 101.00 exceeds original_balance 100.00 with no modification_flag"
    assert out[2].reason == "balance fell by 49.5% in one month without a zero-balance termination" and out[4].reason == "gap of 2 months detected in the monthly reporting sequence"
    assert out[5].reason == "reporting_month 2017-11 precedes origination 2017-12"


def test_runs_and_terminal(spark):
    hit, _ = fired(spark, [{"current_balance": 80.0} for _ in range(9)])
    assert [("R006" in h) for h in hit] == [False] * 6 + [True] * 3
    hit, _ = fired(spark, [{"dlq_months": i % 2} for i in range(6)])
    assert [("R007" in h) for h in hit] == [False] * 3 + [True] * 3
    hit, _ = fired(spark, [{}, {"zero_balance_date": month(1), "is_terminated": True, "current_status": "Prepaid", "remaining_term_months": -1}, {"is_terminated": True, "current_status": "Prepaid"}])
    assert hit == [[], ["R005"], ["R010"]]


def test_feed(spark):
    feed = spark.createDataFrame([("a", month(0), "Current"), ("a", month(1), "Default"), ("a", month(1), "Default")], "loan_id string, reporting_month date, feed_status string")
    hit, out = fired(spark, [{}, {}, {}], feed)
    assert hit == [[], ["R012"], []] and len(out) == 3 and "'Default' versus primary 'Current'" in out[1].reason


def test_features_by_hand(spark):
    specs = [{"dlq_months": m, "current_balance": b, "forbearance_flag": i == 1, "modification_flag": i == 2} for i, (m, b) in enumerate([(0, 100.0), (1, 99.0), (2, 98.0), (0, 96.0), (0, 95.0)])]
    r = features.build(panel(spark, specs)).orderBy("reporting_month").collect()
    assert [x.dpd_lag_1 for x in r] == [None, 0.0, 30.0, 60.0, 0.0] and [x.dpd_lag_3 for x in r] == [None, None, None, 0.0, 30.0]
    assert [x.dpd_mean_3m for x in r] == [0, 15, 30, 30, 20] and [x.delinquent_months_3m for x in r] == [0, 1, 2, 2, 1]
    assert [x.cum_delinquent_months for x in r] == [0, 0, 1, 2, 2] and [x.ever_delinquent for x in r] == [0, 0, 1, 1, 1] and [x.cum_missed_payments for x in r] == [0, 1, 2, 2, 2]
    assert [x.months_since_modification for x in r] == [None, None, 0, 1, 2] and [x.ever_forbearance for x in r] == [0, 1, 1, 1, 1] and [x.forbearance_months for x in r] == [0, 1, 1, 1, 1]
    assert r[3].balance_delta_1m == -2 and r[3].balance_delta_3m == -4 and r[3].balance_pct_change_1m == pytest.approx(-2 / 98)
    assert r[0].credit_risk_score == pytest.approx(100 * (0.45 * 150 / 550 + 0.35 * 80 / 125 + 0.2 * 30 / 65))
    assert [n for n in features.names() if n not in r[0].asDict()] == [] and len(features.names()) == 42


def test_null_components_count_half(spark):
    got = spark.range(1).select(*[F.lit(None).cast("double").alias(c) for c in ("credit_score", "ltv", "dti", "interest_rate")], F.lit(None).cast("int").alias("loan_age_months")).select(*[v.alias(k) for k, v in features.risk().items()]).first()
    assert got.credit_risk_score == pytest.approx(50) and got.debt_burden is None and (got.high_ltv_flag, got.subprime_flag, got.is_seasoned) == (0, 0, 0)


def test_labels(spark):
    specs = [{"dlq_months": m} for m in (0, 0, 0, 1, 0)] + [{"loan_id": "b", "is_terminated": i == 6, "current_status": "Prepaid" if i == 6 else "Current", "prepayment_flag": i == 6, "reporting_month": month(i)} for i in (5, 6)]
    r = labels.add_targets(panel(spark, specs), month(7)).orderBy("loan_id", "reporting_month").collect()
    assert [x.next_3m_delinquency_flag for x in r[:5]] == [1, 1, 1, 0, 0] and [x.next_3m_delinquency_flag_complete for x in r[:5]] == [1, 1, 1, 1, 1]
    assert [x.next_6m_delinquency_flag_complete for x in r[:5]] == [1, 1, 1, 0, 0]
    assert [x.next_state for x in r[:5]] == ["Current", "Current", "Delinquent", "Current", None] and [x.next_state_complete for x in r[:5]] == [1, 1, 1, 1, 0]
    assert r[5].next_12m_prepayment_flag == 1 and r[5].next_12m_default_flag_complete == 1 and r[6].next_state == "Prepaid" and r[6].next_state_complete == 1


def test_splits():
    s = labels.Splits(dt.date(2025, 3, 1))
    assert s.test == (dt.date(2023, 4, 1), dt.date(2024, 3, 1))
    assert labels.Splits(dt.date(2001, 11, 1)).test == (dt.date(1999, 12, 1), dt.date(2000, 11, 1))


def test_splits_are_disjoint_and_train_is_cut(spark, sf):
    p = P.dense(spark, sf)
    got = p.split(**P.TEST_YEARS).groupBy("split").agg(F.min("reporting_month"), F.max("reporting_month")).collect()
    spans = sorted((r[1], r[2]) for r in got if r[0])
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False)) and {r[0] for r in got} == {"train", "validation", "holdout", "test", None}
    assert next(r[2] for r in got if r[0] == "train") <= dt.date(1996, 12, 1)


def exchanges(df, key):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in re.findall(r"Exchange hashpartitioning\(([^,)]*)", plan)]


def test_one_entity_exchange_serves_all_windows(spark):
    base = ingest.with_month_index(clean.repair(rows(spark, [{}, {}])).crossJoin(F.broadcast(static(spark, ("a",)).drop("loan_id"))))
    ruled = rules.apply_rules(base)
    built = labels.add_targets(features.build(ruled), month(5))
    assert len(exchanges(built, "loan_id")) == 1


def test_no_feature_looks_ahead(spark):
    base = ingest.with_month_index(clean.repair(rows(spark, [{}, {}])).crossJoin(F.broadcast(static(spark, ("a",)).drop("loan_id"))))
    plain = base._jdf.queryExecution().optimizedPlan().toString().count("unboundedfollowing")
    plan = features.build(base)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("unboundedfollowing") == plain and not re.search(r"lead\(|RowFrame, [^)]*, [1-9]\d*\)", plan)


def test_reads_only_what_it_needs(spark, sf):
    plan = ingest.population(P.dense(spark, sf).raw)._jdf.queryExecution().executedPlan().toString()
    scan = re.search(r"ReadSchema: struct<([^>]*)>", plan)[1]
    assert {x.split(":")[0] for x in scan.split(",")} <= {"l_suppkey", "l_returnflag", "l_shipdate"}


def test_catalogue_round_trip():
    assert rules.read_catalogue(rules.catalogue()) == C.RULES and len(C.LAYOUT) == 113 and len(C.PARSED) == 45 and C.PRIORITY == ("R001", "R003", "R005", "R010", "R004", "R009", "R012", "R002", "R011", "R006", "R007", "R013", "R008")
