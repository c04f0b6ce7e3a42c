"""The registered queries over the test tables, each with a SQL twin where SQL can say it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyard.functions import scalar as S
from panelyard.functions import windows
from panelyard.operators import anomaly, clean, explain, features, ingest, labels, metrics, models, profile, rules, scenario, segments, serve, survival
from panelyard.plans import contract as C
from panelyard.plans.oracle import chain
from panelyard.plans.panel import TEST_YEARS, dense
from panelyard.sources import testdata
from panelyard.sources.tables import settled
from panelyard.streaming import runs as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the function under its name, with its SQL twin."""
    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f
    return put


def rounded(df: DataFrame, digits: int = 6, to=F.round) -> DataFrame:
    return df.select(*[to(F.col(c), digits).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])


def listed(names, digits: int | None = None) -> str:
    return ", ".join(f"round({n}, {digits}) as {n}" if digits else n for n in names)


KEY = "loan_id, reporting_month"
_MONTHLY = (
    "loan_id reporting_month current_balance current_interest_rate loan_age_months remaining_term_months scheduled_principal non_interest_bearing_upb last_upb dlq_months days_past_due "
    "current_status delinquency default_flag prepayment_flag is_terminated termination_reason zero_balance_code zero_balance_date last_paid_installment modification_flag forbearance_flag "
    "servicer_name default_flag_credit_event default_flag_ex_forbearance source_file ingest_seq").split()
_STATIC = (
    "loan_id original_balance interest_rate original_term_months credit_score co_borrower_credit_score ltv combined_ltv dti credit_score_band ltv_band dti_band origination_month state loan_purpose "
    "property_type occupancy_type channel mi_type seller_name num_borrowers num_units msa zip3 mi_pct product_type first_time_buyer homeready_flag high_balance_flag vintage_year vintage_quarter").split()

_COUNTS = """count(*) as n_records, coalesce(sum(current_balance::decimal(20, 2)), 0)::double as sum_balance, count(*) filter (where delinquency) as n_delinquent,
  count(*) filter (where coalesce(dlq_months >= 3, false)) as n_d90, count(*) filter (where default_flag) as n_default, count(*) filter (where prepayment_flag) as n_prepaid,
  count(*) filter (where is_terminated) as n_terminated, count(*) filter (where dlq_months is null) as n_dlq_unknown, coalesce(sum(dlq_months), 0)::bigint as sum_dlq_months"""
_RATES = ", ".join(f"{n}::double / n_records as {r}" for r, n in (("delinquency_rate", "n_delinquent"), ("default_rate", "n_default"), ("prepayment_rate", "n_prepaid"), ("d90_rate", "n_d90"), ("unknown_rate", "n_dlq_unknown")))


@query(chain(f"select *, {_RATES} from (select reporting_month, {_COUNTS} from mo group by 1)", "mo"))
def population_monthly(spark, sf):
    return ingest.population(testdata.raw_panel(spark, sf))


@query(chain(f"select *, {_RATES} from (select reporting_month, source_file, {_COUNTS} from mo group by grouping sets ((reporting_month), (reporting_month, source_file)))", "mo"))
def population_by_vintage(spark, sf):
    return ingest.population_by_vintage(testdata.raw_panel(spark, sf))


@query(chain(f"select {listed(_MONTHLY)} from mo", "mo"))
def canonical_monthly(spark, sf):
    return dense(spark, sf).monthly.select(*_MONTHLY)


@query(chain(f"select {listed(_STATIC)} from st", "st"))
def canonical_static(spark, sf):
    return dense(spark, sf).static.select(*_STATIC)


@query("""select * from (values ('022018', date '2018-02-01'), ('122025', date '2025-12-01'), ('012018', date '2018-01-01'), ('', null), ('2018', null), ('1320188', null), ('992018', null), (' 012018 ', date '2018-01-01')) t(code, month)""")
def parse_month_codes(spark, sf):
    codes = ["022018", "122025", "012018", "", "2018", "1320188", "992018", " 012018 "]
    return spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in codes])).alias("code")).select("code", S.parse_month(F.col("code")).alias("month"))


def _hashed(key: str, source: str) -> str:
    """(key, x): the 64-bit hash of the sample, in DuckDB's wide integers."""
    return f"""select {key}, xor(c, c >> 31) as x from (select {key}, ((xor(b, b >> 27)::uhugeint * 10723151780598845931::uhugeint) % 18446744073709551616::uhugeint)::ubigint as c from (
    select {key}, ((xor(a, a >> 30)::uhugeint * 13787848793156543929::uhugeint) % 18446744073709551616::uhugeint)::ubigint as b from (select {key}, ({key}::bigint + {zlib.crc32(b"panel")})::ubigint as a from {source})))"""


@query(f"select o_orderkey, (x % 1000000)::bigint as bucket, x % 1000000 < 30000 as in_sample from ({_hashed('o_orderkey', 'orders')})")
def entity_hash_sample(spark, sf):
    bucket = S.hash_bucket(F.col("o_orderkey"), "panel")
    return testdata.table(spark, sf, "orders").select("o_orderkey", bucket.alias("bucket"), S.sampled(F.col("o_orderkey"), 0.03, "panel").alias("in_sample"))


@query(chain("", "mo") + f""", k as (select loan_id, x % 1000000 < 300000 as kept from ({_hashed('loan_id', 'st_ids')})), c as (select kept, count(*) as n from mo join k using (loan_id) group by 1)
select sum(n)::bigint as n_rows, coalesce(sum(n) filter (where kept), 0)::bigint as n_rows_kept, (select count(*) from k) as n_entities, (select count(*) from k where kept) as n_entities_kept, 0.3::double as target_rate,
  round(coalesce(sum(n) filter (where kept), 0) / sum(n), 6) as row_rate, round((select count(*) from k where kept) / (select count(*) from k), 6) as entity_rate from c""".replace("from st_ids", "from (select distinct loan_id from mo)"))
def sample_audit(spark, sf):
    return rounded(ingest.sample_audit(testdata.raw_panel(spark, sf), 0.3, "panel"))


@query("select l_orderkey, l_linenumber, l_partkey from (select *, row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 as n from lineitem) where n % 97 = 0")
def stride_sample(spark, sf):
    items = testdata.table(spark, sf, "lineitem")
    return ingest.stride_sample(items, ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"], 97).select("l_orderkey", "l_linenumber", "l_partkey")


@query()
def seeded_cap(spark, sf):
    return ingest.seeded_cap(testdata.table(spark, sf, "orders"), ["o_orderkey"], 500)


@query("select o_orderkey, o_custkey, o_totalprice from orders order by o_orderkey limit 100")
def head_subset(spark, sf):
    return testdata.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey").limit(100)


def _conflicts(spark, sf):
    items = testdata.table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 101 != 0, F.col("l_orderkey").cast("string")).alias("loan_id"), "l_linenumber", "l_returnflag", "l_linestatus",
        (F.col("l_partkey") * 100_000_000 + F.col("l_suppkey") * 1000 + F.col("l_quantity").cast("int")).alias("ingest_seq"))
    return clean.deduplicate(items, ["loan_id", "l_linenumber"])


_CONFLICTS = """with i as (select case when l_orderkey % 101 <> 0 then l_orderkey::varchar end as loan_id, l_linenumber, l_returnflag, l_linestatus, l_partkey * 100000000 + l_suppkey * 1000 + l_quantity::int as seq from lineitem),
d as (select *, row_number() over (partition by loan_id, l_linenumber, l_returnflag, l_linestatus order by seq) as copy from i),
k as (select *, loan_id is null as lost, count(*) over (partition by loan_id, l_linenumber) as n, row_number() over (partition by loan_id, l_linenumber order by seq) as pos from d where loan_id is null or copy = 1)
"""


@query(_CONFLICTS + "select loan_id, l_linenumber, l_returnflag, l_linestatus from k where not lost and pos = 1")
def clean_deduplicated(spark, sf):
    return _conflicts(spark, sf)[0].drop("ingest_seq")


@query(_CONFLICTS + """select loan_id, l_linenumber, l_returnflag, l_linestatus, case when lost then 'missing_primary_key' else 'conflicting_duplicate_loan_month' end as quarantine_reason from k where lost or n > 1""")
def clean_quarantine(spark, sf):
    return _conflicts(spark, sf)[1].drop("ingest_seq")


@query(chain(f"select {KEY}, current_balance, dlq_months, days_past_due, dlq_status_unreported, balance_imputed, current_balance is null as balance_unrecoverable from cl", "cl"))
def clean_repaired(spark, sf):
    return dense(spark, sf).clean.select("loan_id", "reporting_month", "current_balance", "dlq_months", "days_past_due", "dlq_status_unreported", "balance_imputed", "balance_unrecoverable")


@query(chain(f"select {KEY}, month_index, current_status, state, credit_score_band, ltv_band, dti_band, original_balance from pn", "pn"))
def join_static(spark, sf):
    return dense(spark, sf).joined.select("loan_id", "reporting_month", "month_index", "current_status", "state", "credit_score_band", "ltv_band", "dti_band", "original_balance")


def _rule(r: str):
    def run(spark, sf):
        return dense(spark, sf).ruled.filter(F.col(r)).select("loan_id", "reporting_month")
    run.__name__ = f"rule_{r.lower()}"
    query(chain(f"select {KEY} from ru where {r}", "ru"))(run)


for _r in C.RULES:
    if _r != "R004":
        _rule(_r)


@query(chain(f"""select {KEY} from (select *, case when loan_age_months % 17 <> 0 then current_status when current_status = 'Current' then 'Delinquent' else 'Current' end as status from pn)
  where (status = 'Delinquent' and days_past_due <= 0) or (status = 'Current' and days_past_due > 0)""", "pn"))
def rule_r004(spark, sf):
    """Status and days past due come from one field in the panel, so the status of some months is turned here."""
    p = dense(spark, sf)
    turned = F.when(F.col("loan_age_months") % 17 != 0, F.col("current_status")).when(F.col("current_status") == "Current", "Delinquent").otherwise("Current")
    return rules.apply_rules(p.joined.withColumn("current_status", F.when(F.col("loan_age_months").isNull(), "Current").otherwise(turned)), p.feed).filter("R004").select("loan_id", "reporting_month")

_M = "format('{:,.2f}', current_balance)"
_REASONS = {
    "R001": f"'current_balance ' || {_M} || ' exceeds original_balance ' || format('{{:,.2f}}', original_balance) || ' with no modification_flag'",
    "R002": "'current_balance rose by ' || format('{:,.2f}', delta) || ' versus the prior month without a modification_flag'",
    "R003": "'reporting_month ' || strftime(reporting_month, '%Y-%m') || ' precedes origination ' || strftime(origination_month, '%Y-%m')", "R004": "''",
    "R005": f"'negative value detected: current_balance=' || {_M} || ', remaining_term_months=' || remaining_term_months",
    "R006": "'balance unchanged for ' || stale || ' consecutive months while status is ''' || current_status || ''''",
    "R007": "'status changed ' || flips || ' times in the trailing 12 months, indicating unstable servicer reporting'", "R008": "'delinquency status was not reported by the servicer for this month'",
    "R009": "'remaining_term_months ' || remaining_term_months || ' exceeds original_term_months ' || original_term_months",
    "R010": "'record dated ' || strftime(reporting_month, '%Y-%m') || ' occurs after the loan reached a terminal zero-balance state'",
    "R011": "'balance fell by ' || format('{:.1f}', drop_pct) || '% in one month without a zero-balance termination'",
    "R012": "'servicer_updates reports status ''' || conflict_status || ''' versus primary ''' || current_status || ''''", "R013": "'gap of ' || gap || ' months detected in the monthly reporting sequence'",
}


@query(chain(f"""select {KEY}, dq_penalty, greatest(100 - dq_penalty, 0) as dq_score, n_hard_failures, n_soft_failures, exception_type,
  case {' '.join(f'when {r} then {_REASONS[r]}' for r in C.PRIORITY)} end as reason from ru where dq_penalty > 0""", "ru"))
def rule_scores(spark, sf):
    return dense(spark, sf).ruled.filter("dq_penalty > 0").select("loan_id", "reporting_month", "dq_penalty", "dq_score", "n_hard_failures", "n_soft_failures", "exception_type", "reason")


@query(chain("""select count(*) as n_records, round(avg(greatest(100 - dq_penalty, 0)), 6) as batch_dq_score, count(*) filter (where dq_penalty > 0) as records_with_any_failure,
  count(*) filter (where n_hard_failures > 0) as records_with_hard_failure, round(avg((n_hard_failures > 0)::int) * 100, 6) as pct_with_hard_failure from ru""", "ru"))
def rule_batch_summary(spark, sf):
    return rounded(rules.batch_summary(dense(spark, sf).ruled))


@query(chain(" union all ".join(
    f"select '{r}' as rule_id, '{t.exception_type}' as exception_type, '{t.severity}' as severity, count(*) filter (where {r}) as n_failed, round(count(*) filter (where {r}) * 100.0::double / count(*), 6) as pct_failed from ru" for r, t in C.RULES.items()), "ru"))
def rule_summary(spark, sf):
    return rounded(rules.rule_summary(dense(spark, sf).ruled))


@query(chain(f"""select rule_a, rule_b, n_both, round(n_both::double / n, 6) as support, round(n_both::double * n / (na::double * nb), 6) as lift from (
  {' union all '.join(f"select '{a}' as rule_a, '{b}' as rule_b, count(*) filter (where {a} and {b}) as n_both, count(*) as n, count(*) filter (where {a}) as na, count(*) filter (where {b}) as nb from ru" for i, a in enumerate(C.RULES) for b in list(C.RULES)[i + 1:])}) where n_both > 0""", "ru"))
def rule_pairs(spark, sf):
    return rounded(rules.exception_pairs(dense(spark, sf).ruled))


@query(chain(f"""select {KEY}, current_status, feed_status, has_conflict, is_stale, case when wins then feed_status else current_status end as reconciled_status, has_conflict and not wins as unresolved from (
  select mo.loan_id, mo.reporting_month, current_status, feed_status, coalesce(feed_status <> current_status, false) as has_conflict, coalesce(is_stale, false) as is_stale,
    coalesce(feed_status <> current_status and not is_stale and last_updated_on > last_day(mo.reporting_month), false) as wins
  from mo left join fd using (loan_id, reporting_month))""", "fd"))
def feed_reconciled(spark, sf):
    p = dense(spark, sf)
    return clean.reconcile(p.monthly, p.feed)


@query(chain("select fd.loan_id, fd.reporting_month, feed_status from fd where loan_id in (select loan_id from st where state = 'TX')", "fd"))
def feed_semi_join(spark, sf):
    p = dense(spark, sf)
    return p.feed.join(p.static.filter("state = 'TX'"), "loan_id", "left_semi").select("loan_id", "reporting_month", "feed_status")


def _family(f: str):
    own = features.names(f)

    def run(spark, sf):
        return rounded(dense(spark, sf).features.select("loan_id", "reporting_month", *own))
    run.__name__ = f"features_{f}"
    kinds = ("ever_delinquent", "ever_modified", "ever_forbearance", "is_seasoned", "high_ltv_flag", "subprime_flag", "high_dti_flag")
    query(chain(f"select {KEY}, " + ", ".join(n if n in kinds else f"round({n}, 6) as {n}" for n in own) + " from ft", "ft"))(run)


for _f in features.FAMILIES:
    _family(_f)

_LABELS = [n for h in C.HORIZONS for n in (h, f"{h}_complete")] + ["next_state", "next_state_complete", "next_12m_default_ex_forbearance", "next_12m_default_credit_event"]


@query(chain(f"select {KEY}, {listed(_LABELS)}, months_to_data_end::int as months_to_data_end from tg", "tg"))
def forward_labels(spark, sf):
    p = dense(spark, sf)
    return labels.add_targets(p.joined, labels.data_end(p.monthly)).select("loan_id", "reporting_month", *_LABELS, "months_to_data_end")


@query(chain("select split, count(*) as n_rows, count(distinct loan_id) as n_entities, min(reporting_month) as first_month, max(reporting_month) as last_month, sum(next_12m_default_flag)::bigint as n_default from sp group by 1"))
def split_summary(spark, sf):
    return dense(spark, sf).split(**TEST_YEARS).groupBy("split").agg(
        F.count("*").alias("n_rows"), F.countDistinct("loan_id").alias("n_entities"), F.min("reporting_month").alias("first_month"), F.max("reporting_month").alias("last_month"), F.sum("next_12m_default_flag").alias("n_default"))


_AUDITED = ["credit_score", "days_past_due", "loan_utilization", "credit_risk_score"]


@query(chain(f"""select feature, n_same, n_pairs, round(n_same::double / nullif(n_pairs, 0), 6) as same_share, coalesce(n_same::double / nullif(n_pairs, 0) > 0.999::double, false) as suspicious from (
  {' union all '.join(f"select '{c}' as feature, count(*) filter (where a = b) as n_same, count(*) filter (where a is not null and b is not null) as n_pairs from (select {c} as a, lead({c}) over (partition by loan_id order by reporting_month) as b from ft)" for c in _AUDITED)})""", "ft"))
def leakage_audit(spark, sf):
    return rounded(features.leakage_audit(dense(spark, sf).features, _AUDITED))


# Joins, windows and segments.


@query(chain(f"""select {KEY}, round(servicer_delinquency_rate, 6) as servicer_delinquency_rate, servicer_name, servicer_records from (
  select loan_id, reporting_month, servicer_name, avg(delinquency::int) over w as servicer_delinquency_rate, count(*) over w as servicer_records from mo window w as (partition by servicer_name, reporting_month))""", "mo"))
def servicer_features(spark, sf):
    return rounded(segments.servicer_features(dense(spark, sf).monthly))


_SEG = " union all ".join(f"""select '{s}' as segment, {s}::varchar as value, count(*) as n_records, count(distinct loan_id) as n_entities, sum(current_balance::decimal(20, 2))::double as sum_balance,
  round(avg(delinquency::int), 6) as delinquency_rate, round(avg(default_flag::int), 6) as default_rate, round(avg(prepayment_flag::int), 6) as prepayment_rate from pn group by 2""" for s in ("vintage_year", "credit_score_band", "state", "servicer_name"))


@query(chain(_SEG, "pn"))
def segment_aggregates(spark, sf):
    return rounded(segments.segments(dense(spark, sf).joined))


@query(chain(f"select * from (select *, (row_number() over (partition by segment order by n_records desc, value nulls first))::int as rank from ({_SEG})) where rank <= 12", "pn"))
def segment_top(spark, sf):
    return rounded(segments.top_segments(dense(spark, sf).joined))


@query(chain("""select from_state, to_state, n, round(n / sum(n) over (partition by from_state), 6) as share from (
  select current_status as from_state, nxt as to_state, count(*) as n from (select current_status, lead(current_status) over (partition by loan_id order by reporting_month) as nxt from mo) where nxt is not null group by 1, 2)""", "mo"))
def state_transitions(spark, sf):
    return rounded(segments.transitions(dense(spark, sf).monthly))


@query(chain("""select loan_id, reporting_month, current_status, current_balance from (select *, row_number() over (partition by loan_id order by reporting_month desc) as r from cl) where r = 1""", "cl"))
def latest_row(spark, sf):
    return segments.latest(dense(spark, sf).clean.select("loan_id", "reporting_month", "current_status", "current_balance"))


@query(chain("""select q.loan_id, q.as_of, reporting_month, current_status, current_balance from (select loan_id, date '1998-06-15' as as_of from st) q
  asof left join cl on cl.loan_id = q.loan_id and cl.reporting_month <= q.as_of""", "cl"))
def as_of_join(spark, sf):
    p = dense(spark, sf)
    return segments.as_of(p.clean, p.static.select("loan_id", F.lit("1998-06-15").cast("date").alias("as_of")))


_TREND = "select {k} reporting_month, count(*) as n_records, avg(delinquency::int) as d from pn group by {g} reporting_month"


@query(chain(f"""select reporting_month, n_records, round(d, 6) as delinquency_rate, round(d - lag(d) over (order by reporting_month), 6) as change from ({_TREND.format(k='', g='')})""", "pn"))
def portfolio_trend(spark, sf):
    return rounded(segments.trends(dense(spark, sf).joined))


@query(chain(f"""select state, reporting_month, n_records, round(d, 6) as delinquency_rate, round(d - lag(d) over (partition by state order by reporting_month), 6) as change from ({_TREND.format(k='state,', g='state,')})""", "pn"))
def segment_trend(spark, sf):
    return rounded(segments.trends(dense(spark, sf).joined, "state"))


@query(chain("""select reporting_month, round(q, 6) as dq_score, round(e, 6) as exception_rate, round(q - lag(q) over (order by reporting_month), 6) as change, coalesce(q - lag(q) over (order by reporting_month) < -1, false) as alert
  from (select reporting_month, avg(greatest(100 - dq_penalty, 0)) as q, avg((dq_penalty > 0)::int) as e from ru group by 1)""", "ru"))
def quality_trend(spark, sf):
    return rounded(segments.quality_trend(dense(spark, sf).ruled, 1.0))


@query(chain("""select loan_id, at, kind, detail from (
  select loan_id, reporting_month as at, 'status' as kind, current_status as detail from ru where prev_status is null or prev_status <> current_status
  union all select loan_id, last_updated_on, 'feed', feed_status from fd union all select loan_id, reporting_month, 'exception', exception_type from ru where exception_type is not null)""".replace(" at,", ' "at",').replace("as at", 'as "at"'), "ru"))
def loan_timeline(spark, sf):
    p = dense(spark, sf)
    return segments.timeline(p.ruled, p.feed)


@query(chain("""select case when loan_age_months is null then 'unknown' when loan_age_months <= 12 then '0-12' when loan_age_months <= 24 then '13-24' when loan_age_months <= 36 then '25-36' when loan_age_months <= 60 then '37-60'
  when loan_age_months <= 120 then '61-120' else '121+' end as age_bucket, count(*) as n_records, round(avg(default_flag::int), 6) as default_rate from pn group by 1""", "pn"))
def age_buckets(spark, sf):
    return rounded(segments.age_buckets(dense(spark, sf).joined))


_CODED = ["state", "channel", "loan_purpose"]


@query(chain(f"""select "column", value, (row_number() over (partition by "column" order by value = '?', n desc, value) - 1)::int as code, n, round(n / sum(n) over (partition by "column"), 6) as share from (
  {' union all '.join(f"select '{c}' as " + '"column"' + f", coalesce({c}, '?') as value, count(*) as n from st group by 2" for c in _CODED)})""", "st"))
def static_encodings(spark, sf):
    return rounded(segments.encodings(dense(spark, sf).static, _CODED))


@query(chain(f"select {KEY}, count(*) over (partition by loan_id order by reporting_month rows between 1 following and 12 following) as rows_ahead_12m from pn", "pn"))
def rows_ahead(spark, sf):
    return dense(spark, sf).joined.select("loan_id", "reporting_month", windows.rows_ahead(12).alias("rows_ahead_12m"))


# Profiles.

_PROFILED = ("CHANNEL", "PURPOSE", "STATE", "CSCORE_B", "DLQ_STATUS", "Zero_Bal_Code")
_RAW_SQL = {
    "CHANNEL": "['R', 'C', 'B', 'X'][(k % 4) + 1]", "PURPOSE": "['P', 'C', 'R', 'U', ''][(k % 5) + 1]", "STATE": "['', 'TX', 'CA', 'NY', 'FL', 'OH', 'WA', 'IL'][(k % 8) + 1]",
    "CSCORE_B": "case when k % 13 = 0 then '' else (500 + k * 37 % 351)::varchar end", "DLQ_STATUS": "case when (k + mi) % 11 = 0 then 'XX' else lpad(greatest(0, x)::varchar, 2, '0') end", "Zero_Bal_Code": "code"}


@query(chain(f"""select idx, "column", sum(n)::bigint as n, round(sum(case when v <> '' then n else 0 end) / sum(n), 6) as fill_rate, count(*) filter (where v <> '') as n_distinct,
  coalesce(string_agg(v, ',' order by r) filter (where v <> '' and r <= 3), '') as examples, coalesce(min(len(v)) filter (where v <> ''), 0)::int as min_len, max(len(v))::int as max_len from (
  select *, row_number() over (partition by idx, v <> '' order by n desc, v) as r from (select idx, "column", v, count(*) as n from (
    {' union all '.join(f"select {i} as idx, '{c}' as " + '"column"' + f", {_RAW_SQL[c]} as v from b" for i, c in enumerate(_PROFILED))}) group by 1, 2, 3)) group by 1, 2""", "b"))
def column_profile(spark, sf):
    return rounded(profile.columns(testdata.raw_panel(spark, sf), list(_PROFILED)))


@query()
def column_profile_approximate(spark, sf):
    return profile.columns(testdata.raw_panel(spark, sf), list(_PROFILED), approximate=True)


@query(chain("select state as value, count(*) as n from st group by 1 order by n desc, value nulls first limit 20", "st"))
def value_counts(spark, sf):
    return profile.value_counts(dense(spark, sf).static, "state")


@query(chain("""select "column", period, n, n_missing, round(n_missing / n, 6) as missing_rate, round(n_missing / n - lag(n_missing / n) over (partition by "column" order by period), 6) as change from (
  select 'dlq_months' as "column", reporting_month as period, count(*) as n, count(*) filter (where dlq_months is null) as n_missing from mo group by 2
  union all select 'last_upb', reporting_month, count(*), count(*) filter (where last_upb is null) from mo group by 2)""", "mo"))
def missingness(spark, sf):
    return rounded(profile.missingness(dense(spark, sf).monthly, ["dlq_months", "last_upb"], "reporting_month"))


_CORR = [("credit_score", "ltv"), ("credit_score", "dti"), ("credit_score", "original_balance"), ("ltv", "dti"), ("ltv", "original_balance"), ("dti", "original_balance")]


@query(chain(" union all ".join(f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as corr from st" for a, b in _CORR), "st"))
def correlations(spark, sf):
    return rounded(profile.correlations(dense(spark, sf).static, ["credit_score", "ltv", "dti", "original_balance"]))


@query(chain("""select max(n)::bigint as n, round(sqrt(greatest(sum(o::double * o / (ra::double * rb)) - 1, 0) / nullif(least(count(distinct a), count(distinct b)) - 1, 0)), 6) as cramers_v from (
  select *, sum(o) over (partition by a) as ra, sum(o) over (partition by b) as rb, sum(o) over () as n from (select current_status as a, servicer_name as b, count(*) as o from mo group by 1, 2))""", "mo"))
def cramers_v(spark, sf):
    return rounded(profile.cramers_v(dense(spark, sf).monthly, "current_status", "servicer_name"))


@query("""select (case when o_totalprice < 1000 then 0 when o_totalprice >= 400000 then 21 else floor((o_totalprice - 1000) / 19950) + 1 end)::int as bin, count(*) as n from orders group by 1""")
def histogram(spark, sf):
    return profile.histogram(testdata.table(spark, sf, "orders"), "o_totalprice", 1000, 400000, 20)


@query("""with q as (select quantile_cont(o_totalprice, 0.25) as a, quantile_cont(o_totalprice, 0.75) as b from orders)
select o_orderkey, 'o_totalprice' as feature, o_totalprice as value from orders, q where o_totalprice < a - 0.2 * (b - a) or o_totalprice > b + 0.2 * (b - a)""")
def iqr_outliers(spark, sf):
    return profile.outliers(testdata.table(spark, sf, "orders"), ["o_totalprice"], ["o_orderkey"], 0.2)


@query(chain(f"select {KEY}, case when reporting_month > date '2001-06-01' then 'after_cutoff' else 'before_range' end as problem from mo where reporting_month < date '1995-03-01' or reporting_month > date '2001-06-01'", "mo"))
def date_checks(spark, sf):
    return profile.date_checks(dense(spark, sf).monthly, "1995-03-01", "2001-06-01")


@query(chain(f"""select loan_id, original_balance, coalesce(dti, m) as dti, dti is null as dti_imputed from st left join (select state, median(dti) as m from st group by 1) using (state)""", "st"))
def segment_imputation(spark, sf):
    return clean.impute_by_segment(dense(spark, sf).static.select("loan_id", "original_balance", "dti", "state"), "dti", "state").drop("state")


# Evaluation: a score with ties against the three-month delinquency label.

_SCORED = "scored as (select loan_id, reporting_month, state, next_3m_delinquency_flag as label, ((850 - coalesce(credit_score, 600)) + least(dpd_max_12m, 360)) / 1000 as score, days_past_due, current_balance, loan_age_months, split from sp where next_3m_delinquency_flag_complete = 1)"


def _scored(spark, sf):
    """What evaluation reads, computed once: its queries go over it several times."""
    rows = dense(spark, sf).split(**TEST_YEARS).filter("next_3m_delinquency_flag_complete = 1")
    score = ((850 - F.coalesce("credit_score", F.lit(600.0))) + F.least("dpd_max_12m", F.lit(360.0))) / 1000
    return settled(rows.select("state", "split", "days_past_due", "current_balance", "loan_age_months", score.alias("score"), F.col("next_3m_delinquency_flag").alias("label")))


def _evaluated(select: str) -> str:
    curve = """curve as (select *, sum(pos) over (order by score desc) as tp, sum(neg) over (order by score desc) as fp, sum(pos) over () as p, sum(neg) over () as n from (
      select score, sum(label) as pos, sum(1 - label) as neg from scored group by 1)),
    rates as (select *, tp / (tp + fp) as prec, tp / p as rec, coalesce(2 * (tp / (tp + fp)) * (tp / p) / nullif(tp / (tp + fp) + tp / p, 0), 0) as f1, greatest(1, floor((p + n) * 0.1)) as k from curve)"""
    return chain("", "sp") + f", {_SCORED}, {curve}\n{select}"


@query(_evaluated("""select round(sum(pos * (n - fp + neg / 2) / (p * n)), 6) as roc_auc, round(sum(pos / p * prec), 6) as pr_auc, round(max(abs((tp - pos) / p - (fp - neg) / n)), 6) as ks,
  round(sum(greatest(0, least(pos + neg, k - (tp + fp - pos - neg))) * pos / (pos + neg) / k / (p / (p + n))), 6) as lift_top, round(max(f1), 6) as f1,
  round((select score from rates order by f1 desc, score limit 1), 6) as threshold from rates"""))
def ranking_metrics(spark, sf):
    return rounded(metrics.ranking(_scored(spark, sf)))


@query(_evaluated(" union all ".join(f"select {f}::double as min_precision, round(rec, 6) as recall, round(prec, 6) as precision, round(score, 6) as threshold from (select * from (select rec, prec, score from rates where prec >= {f} order by rec desc, score limit 1) union all select 0, (select max(prec) from rates), 1 where not exists (select 1 from rates where prec >= {f}))" for f in (0.05, 0.1, 0.3))))
def recall_at_precision(spark, sf):
    return rounded(metrics.recall_at_precision(_scored(spark, sf), (0.05, 0.1, 0.3)))


@query(_evaluated("""select count(*) as n, sum(label)::bigint as n_positive, round(avg(label), 6) as base_rate, round(avg((label - score) ** 2), 6) as brier,
  round(avg(-(label * ln(least(greatest(score, 1e-7), 1 - 1e-7)) + (1 - label) * ln(1 - least(greatest(score, 1e-7), 1 - 1e-7)))), 6) as log_loss, round(1 - avg((label - score) ** 2) / (avg(label) * (1 - avg(label))), 6) as brier_skill from scored"""))
def error_metrics(spark, sf):
    return rounded(metrics.errors(_scored(spark, sf)))


@query(_evaluated("""select tp, fp, fn, tn, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall, round((tp + tn) / (tp + fp + fn + tn), 6) as accuracy from (
  select count(*) filter (where score >= 0.3 and label = 1) as tp, count(*) filter (where score >= 0.3 and label = 0) as fp, count(*) filter (where score < 0.3 and label = 1) as fn, count(*) filter (where score < 0.3 and label = 0) as tn from scored)"""))
def confusion_counts(spark, sf):
    return rounded(metrics.confusion(_scored(spark, sf), 0.3))


@query(_evaluated("""select state, n, fp, fn, n_positive, round(fp / nullif(n - n_positive, 0), 6) as fp_rate, round(fn / nullif(n_positive, 0), 6) as fn_rate from (
  select state, count(*) as n, count(*) filter (where score >= 0.3 and label = 0) as fp, count(*) filter (where score < 0.3 and label = 1) as fn, count(*) filter (where label = 1) as n_positive from scored group by 1)"""))
def error_slices(spark, sf):
    return rounded(metrics.slices(_scored(spark, sf), "state", 0.3))


@query(_evaluated("""select bin::int as bin, count(*) as n, round(avg(score), 6) as mean_predicted, round(avg(label), 6) as observed_rate, round(count(*) / (select count(*) from scored), 6) as weight, round(abs(avg(score) - avg(label)), 6) as gap from (
  select score, label, len(list_filter(inner_edges, lambda e: score >= e)) as bin from scored, (select e[2:len(e) - 1] as inner_edges from (select list_sort(list_distinct(quantile_cont(score, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1]))) as e from scored))) group by 1"""))
def calibration_curve(spark, sf):
    return rounded(metrics.calibration(_scored(spark, sf)))


@query(chain("""select label, support, tp, n_predicted, round(f1, 6) as f1, round(sum(tp) over () / sum(support) over (), 6) as accuracy, round(avg(f1) over (), 6) as macro_f1, round(sum(f1 * support) over () / sum(support) over (), 6) as weighted_f1 from (
  select label, sum(s)::bigint as support, sum(t)::bigint as tp, sum(q)::bigint as n_predicted, coalesce(2 * sum(t) / nullif(sum(s) + sum(q), 0), 0) as f1 from (
    select next_state as label, 1 as s, (next_state = current_status)::int as t, 0 as q from tg where next_state_complete = 1 union all select current_status, 0, 0, 1 from tg where next_state_complete = 1) group by 1)""", "tg"))
def multiclass_metrics(spark, sf):
    p = dense(spark, sf)
    rows = labels.add_targets(p.joined, labels.data_end(p.monthly)).filter("next_state_complete = 1")
    return rounded(metrics.multiclass(rows, "next_state", "current_status"))


@query(chain("select next_state as actual, current_status as predicted, count(*) as n from tg where next_state_complete = 1 group by 1, 2", "tg"))
def multiclass_confusion(spark, sf):
    p = dense(spark, sf)
    rows = labels.add_targets(p.joined, labels.data_end(p.monthly)).filter("next_state_complete = 1")
    return metrics.confusion_matrix(rows, "next_state", "current_status")


_DRIFT = ["score", "days_past_due", "current_balance", "loan_age_months"]


@query(chain("", "sp") + f", {_SCORED}, long as (" + " union all ".join(f"select '{c}' as feature, {c}::double as v, split from scored" for c in _DRIFT) + """),
edges as (select feature, list_sort(list_distinct(quantile_cont(v, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1]))) as e from long where split = 'train' group by 1),
binned as (select l.feature, split, v, case when v = e[len(e)] then len(e) - 1 when v < e[1] or v > e[len(e)] then 0 else len(list_filter(e, lambda x: x <= v)) end as bin from long l join edges using (feature) where split in ('train', 'test') and v is not null),
counts as (select feature, bin, count(*) filter (where split = 'train') as e, count(*) filter (where split = 'test') as a from binned group by 1, 2),
totals as (select feature, count(*) filter (where split = 'train') as ne, count(*) filter (where split = 'test') as na, avg(v) filter (where split = 'train') as me, avg(v) filter (where split = 'test') as ma from binned group by 1),
bins as (select feature, unnest(generate_series(1, len(e) - 1)) as bin, len(e) as n_edges from edges),
shares as (select feature, n_edges, greatest(coalesce(e, 0) / ne, 1e-6) as e, greatest(coalesce(a, 0) / na, 1e-6) as a from bins left join counts using (feature, bin) join totals using (feature)),
scores as (select feature, case when max(n_edges) < 3 then 0 else sum((a - e) * ln(a / e)) end as psi from shares group by 1)
select feature, round(psi, 6) as psi, case when psi < 0.1 then 'stable' when psi < 0.25 then 'moderate' else 'significant' end as severity, round(me + 1e-9, 4) as expected_mean, round(ma + 1e-9, 4) as actual_mean from scores join totals using (feature)""")
def drift_report(spark, sf):
    rows = _scored(spark, sf)
    found = metrics.drift(rows.filter("split = 'train'"), rows.filter("split = 'test'"), _DRIFT)
    # Means of thousandths may lie on a rounding boundary, where the order of a sum would tell.
    return found.select("feature", F.round("psi", 6).alias("psi"), "severity", *[F.round(F.col(c) + 1e-9, 4).alias(c) for c in ("expected_mean", "actual_mean")])


# Anomalies, scenarios, survival.

_FUSED = chain("", "ru") + """, base as (select *, (850 - coalesce(credit_score, 600)) as raw from ru),
fused as (select * exclude (exception_type), (raw - min(raw) over ()) / nullif(max(raw) over () - min(raw) over (), 0) as ml_anomaly_score, least(dq_penalty / 100, 1) as rule_score, exception_type as rule_type from base),
scores as (select *, least(greatest(rule_score, ml_anomaly_score * 0.85), 1) as anomaly_score, coalesce(rule_type, case when ml_anomaly_score > 0.75 then 'statistical_outlier' end) as exception_type from fused)
"""


def _fused(spark, sf):
    """Fused scores with a linear stand-in for the forest's, computed once."""
    raw = (850 - F.coalesce("credit_score", F.lit(600.0))).alias("_raw")
    rows = settled(dense(spark, sf).ruled.select("loan_id", "reporting_month", "dq_penalty", "exception_type", "reason", raw))
    low, high = (rows.agg(f("_raw")).scalar() for f in (F.min, F.max))
    return settled(anomaly.fuse(rows.withColumn("ml_anomaly_score", S.ratio(F.col("_raw") - low, high - low))))


@query(_FUSED + f"select {KEY}, round(ml_anomaly_score, 6) as ml_anomaly_score, round(rule_score, 6) as rule_score, round(anomaly_score, 6) as anomaly_score, exception_type from scores")
def anomaly_fusion(spark, sf):
    return rounded(_fused(spark, sf).select("loan_id", "reporting_month", "ml_anomaly_score", "rule_score", "anomaly_score", "exception_type"))


@query(_FUSED + f""", flagged as (select * from scores where anomaly_score > 0), size as (select greatest(2, 40 // greatest(count(distinct exception_type), 1)) as per from flagged),
picks as (select * from (select *, row_number() over (partition by exception_type order by anomaly_score desc, loan_id, reporting_month) as r from flagged) where r <= (select per from size)),
extra as (select * from flagged anti join picks using (loan_id, reporting_month) order by anomaly_score desc, loan_id, reporting_month limit greatest(0, 40 - (select count(*) from picks))),
chosen as (select loan_id, reporting_month, anomaly_score, exception_type from picks union all select loan_id, reporting_month, anomaly_score, exception_type from extra)
select loan_id, reporting_month, round(anomaly_score, 6) as anomaly_score, exception_type from chosen order by anomaly_score desc, loan_id, reporting_month limit 40""")
def anomaly_examples(spark, sf):
    return rounded(anomaly.examples(_fused(spark, sf), ["loan_id", "reporting_month"], 40).select("loan_id", "reporting_month", "anomaly_score", "exception_type"))


_Z = ["current_balance", "credit_score", "loan_age_months", "remaining_term_months", "interest_rate"]


@query(chain("", "pn") + ", long as (" + " union all ".join(f"select loan_id, reporting_month, '{c}' as f, {c}::double as v from pn" for c in _Z) + f"""),
m as (select f, quantile_cont(v, 0.5) as med from long group by 1), d as (select f, quantile_cont(abs(v - med), 0.5) as mad from long join m using (f) group by 1),
z as (select loan_id, reporting_month, f, abs((v - med) / nullif(mad, 0)) as z from long join m using (f) join d using (f) where v is not null and mad > 0)
select loan_id, reporting_month, list(f order by z desc, f)[1:4] as fields, round(max(z), 6) as top_z from z group by 1, 2""")
def anomaly_drivers(spark, sf):
    rows = settled(dense(spark, sf).joined.select("loan_id", "reporting_month", *_Z))
    found = anomaly.drivers(rows, _Z, ["loan_id", "reporting_month"])
    return rounded(found.select("loan_id", "reporting_month", F.transform("drivers", lambda d: d["field"]).alias("fields"), F.col("drivers")[0]["robust_z"].alias("top_z")))


def _forest(rows):
    forest, middle = anomaly.fit(rows, _Z, ["loan_id", "reporting_month"])
    return anomaly.score(rows, forest, middle, _Z)


def _judged(spark, sf):
    return settled(dense(spark, sf).ruled.select("loan_id", "reporting_month", "n_hard_failures", "dq_penalty", "exception_type", *_Z))


@query()
def isolation_forest(spark, sf):
    return _forest(_judged(spark, sf)).select("loan_id", "reporting_month", "ml_anomaly_score", "ml_outlier", "rule_score", "anomaly_score", "exception_type")


@query(_FUSED + f""", advice(t, recommendation) as (values {', '.join(f"('{t}', '{x}')" for t, x in ((t, x.replace("'", "''")) for t, x in anomaly.RECOMMENDATIONS.items()))})
select s.exception_type, recommendation, count(*) as n from scores s join advice on t = s.exception_type group by 1, 2""")
def anomaly_advice(spark, sf):
    rows = _fused(spark, sf).filter("exception_type is not null")
    return rows.groupBy("exception_type", S.decode(F.col("exception_type"), anomaly.RECOMMENDATIONS, anomaly.OTHERWISE).alias("recommendation")).agg(F.count("*").alias("n"))


@query(_FUSED + "select count(*) as n_records, count(*) filter (where anomaly_score > 0.5) as n_anomalies, round(avg(anomaly_score), 6) as mean_score, count(distinct exception_type) as n_types from scores")
def anomaly_summary(spark, sf):
    return rounded(anomaly.summary(_fused(spark, sf)))


_SIM = """sc(scenario_name, rate, dpd, mult) as (values ('base', 0, 0, 1.0::double), ('adverse_credit', 100, 1, 2.6::double), ('high_prepayment', -150, 0, 0.75::double)),
stressed as (select scenario_name, state, least(greatest((0.01::double * (current_interest_rate + rate / 10000.0::double) + least(days_past_due + dpd * 30.0::double, 360) / 720.0::double) * mult, 0), 1) as p from pn, sc)"""


def _stress_score(df):
    return df.withColumn("score", 0.01 * F.col("current_interest_rate") + F.least(F.col("days_past_due"), F.lit(360.0)) / 720.0)


@query(chain("", "pn") + f", {_SIM} select scenario_name, count(*) as n, round(avg(p), 6) as portfolio_rate from stressed group by 1")
def scenario_simulation(spark, sf):
    return rounded(scenario.simulate(dense(spark, sf).joined, scenario.scenarios(spark), "next_12m_default_flag", _stress_score))


@query(chain("", "pn") + f", {_SIM} select scenario_name, state, count(*) as n, round(avg(p), 6) as portfolio_rate from stressed group by grouping sets ((scenario_name), (scenario_name, state))")
def scenario_by_segment(spark, sf):
    return rounded(scenario.simulate(dense(spark, sf).joined, scenario.scenarios(spark), "next_12m_default_flag", _stress_score, ["state"]).drop("level"))


@query(chain("", "pn") + f""", {_SIM}, r as (select avg(p) filter (where scenario_name = 'base') as b, avg(p) filter (where scenario_name = 'adverse_credit') as a, avg(p) filter (where scenario_name = 'high_prepayment') as h from stressed)
select round(b, 6) as base, round(a, 6) as adverse_credit, round(h, 6) as high_prepayment, round(a - b, 6) as adverse_credit_delta, round(h - b, 6) as high_prepayment_delta from r""")
def scenario_comparison(spark, sf):
    return rounded(scenario.compare(scenario.simulate(dense(spark, sf).joined, scenario.scenarios(spark), "next_12m_default_flag", _stress_score)))


_LIVES = """lives as (select loan_id, coalesce(min(loan_age_months) filter (where default_flag), max(loan_age_months)) as age, max(default_flag::int) as event, min(loan_age_months) as entry from mo group by 1)"""


@query(chain("", "mo") + f""", {_LIVES}, ages as (select age from lives union select entry from lives),
t as (select age, (select count(*) from lives where lives.age = ages.age) as leaving, (select coalesce(sum(event), 0) from lives where lives.age = ages.age)::bigint as events, (select count(*) from lives where entry = ages.age) as entering from ages),
r as (select *, (sum(entering) over (order by age rows unbounded preceding) - coalesce(sum(leaving) over (order by age rows between unbounded preceding and 1 preceding), 0))::bigint as at_risk from t),
h as (select *, coalesce(events::double / nullif(at_risk, 0), 0) as hazard from r)
select age, leaving, events, entering, at_risk, round(hazard, 6) as hazard, round(case when max((hazard >= 1)::int) over w = 1 then 0 else exp(sum(ln(case when hazard < 1 then 1 - hazard else 1 end)) over w) end, 6) as survival,
  round(1 - case when max((hazard >= 1)::int) over w = 1 then 0 else exp(sum(ln(case when hazard < 1 then 1 - hazard else 1 end)) over w) end, 6) as incidence from h window w as (order by age rows unbounded preceding)""")
def survival_curve(spark, sf):
    return rounded(survival.kaplan_meier(survival.durations(dense(spark, sf).monthly)), to=S.round_scaled)


@query(chain("", "mo") + f", {_LIVES} select sum(event)::bigint as events, sum(age - entry + 1)::bigint as months, round(sum(event) / sum(age - entry + 1), 6) as hazard from lives")
def survival_naive(spark, sf):
    return rounded(survival.naive(survival.durations(dense(spark, sf).monthly)))


@query(chain("", "mo") + """, lives as (select loan_id, servicer_name, coalesce(min(loan_age_months) filter (where default_flag), max(loan_age_months)) as age, max(default_flag::int) as event, min(loan_age_months) as entry from mo group by 1, 2)
select servicer_name, sum(event)::bigint as events, count(*) as n_entities, max(age)::int as last_age from lives group by 1""")
def incidence_by_segment(spark, sf):
    """Of every servicer's curve its ends: events, entities and the last age reached."""
    lives = survival.durations(dense(spark, sf).monthly, keep=["servicer_name"])
    curve = survival.kaplan_meier(lives, ["servicer_name"])
    return curve.groupBy("servicer_name").agg(F.sum("events").alias("events"), F.sum("leaving").alias("n_entities"), F.max("age").cast("int").alias("last_age"))


# Models.

_INPUTS = ["days_past_due", "dpd_max_6m", "dpd_mean_12m", "cum_delinquent_months", "credit_risk_score", "loan_utilization", "loan_age_months", "balance_pct_change_1m"]


def _labelled(spark, sf):
    """What models read, computed once: training, calibration and scoring go over it."""
    names = dict.fromkeys(["loan_id", "reporting_month", "split", *_INPUTS, *_LABELS])
    return settled(dense(spark, sf).split(**TEST_YEARS).select(*names))


def _fitted(spark, sf, algorithm="logistic_regression", target="next_3m_delinquency_flag", rows=None):
    rows = _labelled(spark, sf) if rows is None else rows
    keys = ["loan_id", "reporting_month"]
    parts = [models.load_split(rows, s, target, keys) for s in ("train", "validation")]
    return rows, models.train(*parts, target, _INPUTS, algorithm)


@query()
def model_scores(spark, sf):
    rows, bundle = _fitted(spark, sf)
    scored = bundle.score(rows.filter("split = 'test'"), "p")
    return scored.select("loan_id", "reporting_month", F.round("p", 6).alias("p"), serve.risk_level(F.col("p")).alias("risk_level"), serve.action(F.lit(False), F.col("p")).alias("action"))


@query()
def model_explanations(spark, sf):
    rows, bundle = _fitted(spark, sf)
    return explain.explain(rows.filter("split = 'test'"), bundle, ["loan_id", "reporting_month"])


@query()
def model_next_state(spark, sf):
    """The algorithm with the best macro F1 on the validation rows, on the test rows."""
    rows = _labelled(spark, sf)
    bundle, _ = models.best_states(rows.filter("split = 'train'"), rows.filter("split = 'validation'"), _INPUTS, trees=20)
    return metrics.multiclass(bundle.score(rows.filter("split = 'test' and next_state_complete = 1")), "next_state", "predicted_state")


@query()
def model_next_state_auc(spark, sf):
    rows = _labelled(spark, sf)
    bundle = models.train_states(rows.filter("split = 'train'"), _INPUTS, "logistic_regression")
    return metrics.one_vs_rest(bundle.score(rows.filter("split = 'test' and next_state_complete = 1")), "next_state", "state_probabilities")


@query()
def model_bands(spark, sf):
    """Uncertainty bands: what the algorithms agree on, and how far they are apart."""
    rows, linear = _fitted(spark, sf)
    _, forest = _fitted(spark, sf, "random_forest", rows=rows)
    return models.spread([linear, forest], rows.filter("split = 'test'"), ["loan_id", "reporting_month"])


_AUC = """select label, n_positive, auc from (select label, sum(pos)::bigint as n_positive, round(sum(pos * (below + neg / 2)) / nullif(sum(pos) * sum(neg), 0), 6) as auc from (
  select *, sum(neg) over (partition by label order by score) - neg as below from (
    select label, score, count(*) filter (where next_state = label) as pos, count(*) filter (where next_state <> label) as neg from held group by 1, 2)) group by 1)"""
_STATES = ("Current", "Delinquent")


@query(chain("", "tg") + f""", held as ({' union all '.join(f"select next_state, '{x}' as label, round(case when current_status = '{x}' then 0.9 else 0.1 end - days_past_due / 7200, 6) as score from tg where next_state_complete = 1 and next_state is not null" for x in _STATES)}) {_AUC}""")
def one_vs_rest_auc(spark, sf):
    p = dense(spark, sf)
    rows = labels.add_targets(p.joined, labels.data_end(p.monthly)).filter("next_state_complete = 1 and next_state is not null")
    each = [x for s in _STATES for x in (F.lit(s), F.round(F.when(F.col("current_status") == s, 0.9).otherwise(0.1) - F.col("days_past_due") / 7200, 6))]
    return rounded(metrics.one_vs_rest(rows.withColumn("p", F.create_map(*each)), "next_state", "p"))


@query()
def survival_projection(spark, sf):
    rows, bundle = _fitted(spark, sf)
    return survival.curves(segments.latest(rows.select("loan_id", "reporting_month", *_INPUTS)), bundle.score, 24)


# Serving.


@query(chain("select loan_id, state, credit_score_band, ltv_band, dti_band, loan_purpose, original_balance, vintage_year from st where state = 'CA' order by loan_id limit 5 offset 5", "st"))
def loan_list(spark, sf):
    return serve.loans(dense(spark, sf).static, state="CA", number=2, size=5)


@query(chain("select loan_id, state from st where loan_id > '20' order by loan_id limit 10", "st"))
def loan_list_keyset(spark, sf):
    return serve.after(dense(spark, sf).static.select("loan_id", "state"), "loan_id", "20", 10)


@query(chain("""select st.loan_id, state, ltv, reporting_month, current_status, current_balance, days_past_due, loan_age_months from st left join (
  select * from (select *, row_number() over (partition by loan_id order by reporting_month desc) as r from cl) where r = 1) l using (loan_id)""", "cl"))
def loan_detail(spark, sf):
    p = dense(spark, sf)
    return serve.loan_detail(p.static.select("loan_id", "state", "ltv"), p.clean)


@query(_FUSED + "select loan_id, reporting_month, round(anomaly_score, 6) as anomaly_score, exception_type from scores where anomaly_score >= 0.3 and exception_type = 'date_conflict' order by anomaly_score desc, loan_id, reporting_month limit 25")
def anomaly_list(spark, sf):
    return rounded(serve.anomalies(_fused(spark, sf), 0.3, "date_conflict").drop("reason"))


@query("""select o_orderkey, case when p < 0.02 then 'low' when p < 0.1 then 'medium' when p < 0.25 then 'high' else 'critical' end as risk_level, case when p > 0.1 then 'Review' else 'Auto-Approve' end as action
from (select o_orderkey, (o_orderkey % 100) / 200 as p from orders)""")
def risk_tiers(spark, sf):
    p = (F.col("o_orderkey") % 100) / 200
    return testdata.table(spark, sf, "orders").select("o_orderkey", serve.risk_level(p).alias("risk_level"), serve.action(F.lit(False), p).alias("action"))


@query()
def predictions(spark, sf):
    """Answers for loans, known and unknown: a model for each target, the forest's and the rules' scores, the best drivers."""
    key = ["loan_id", "reporting_month"]
    rows = _labelled(spark, sf)
    test = rows.filter("split = 'test'")
    targets = ["next_3m_delinquency_flag", "next_12m_default_flag", "next_12m_prepayment_flag"]
    scored = test
    for target in targets:
        if rows.filter((F.col("split") == "train") & (F.col(target) == 1)).isEmpty():
            # Nothing to learn from: the share of the training rows, which is none.
            scored = scored.withColumn(f"_{target}", F.lit(0.0))
            continue
        _, bundle = _fitted(spark, sf, target=target, rows=rows)
        scored = bundle.score(scored, f"_{target}")
        if target == targets[0]:
            why = explain.explain(test, bundle, key)
    if "why" not in locals():
        why = test.select(*key, F.array().cast("array<struct<feature:string,contribution:double,effect:string>>").alias("drivers"))
    states = models.train_states(rows.filter("split = 'train'"), _INPUTS, "logistic_regression").score(scored)
    odd = _forest(_judged(spark, sf)).select(*key, "anomaly_score", "exception_type")
    given = states.drop(*targets).withColumnsRenamed({f"_{t}": t for t in targets})
    fused = segments.latest(given.join(why, key).join(odd, key, "left").select(*key, *targets, "predicted_state", "confidence", "drivers", "anomaly_score", "exception_type"))
    out = serve.submission(fused, targets)
    return serve.predict(testdata.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("loan_id")), out)


# Streams over the events table, run to their end.


@query("select date_trunc('day', ts)::timestamp as start, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2")
def stream_daily(spark, sf):
    return streams.daily(spark, sf)


@query("select user_id, event_type, count(*) as n from (select distinct user_id, event_type, date_trunc('day', ts) from events) group by 1, 2")
def stream_distinct_days(spark, sf):
    return streams.distinct_days(spark, sf)
