"""Registered queries that go through a sink, a source or a stream: what was written is read back, and models' answers from known inputs."""

from __future__ import annotations

import uuid
from decimal import Decimal

from pyspark.sql import functions as F

from panelyard.functions import scalar as S
from panelyard.operators import ingest, rules, segments, serve, survival
from panelyard.plans import contract as C
from panelyard.plans.oracle import chain
from panelyard.plans.panel import dense
from panelyard.plans.queries import ORACLES, QUERIES, query, rounded
from panelyard.sources import archives, sinks, testdata
from panelyard.sources.tables import shared_dir
from panelyard.streaming import panel as streams
from panelyard.streaming.runs import finish

__all__ = ["ORACLES", "QUERIES"]


def _folder(spark) -> str:
    return f"{shared_dir(spark)}/exchange/{uuid.uuid4().hex}"


@query(ORACLES["population_monthly"])
def delimited_round_trip(spark, sf):
    """Raw records as delimited text, read by the raw contract and aggregated."""
    raw, at = testdata.raw_panel(spark, sf), _folder(spark)
    wide = raw.select(*[F.col(f.name) if f.name in raw.columns else F.lit("").alias(f.name) for f in C.LAYOUT])
    wide.write.option("sep", "|").option("quote", "").option("emptyValue", "").csv(at)
    return ingest.population(archives.read_delimited(spark, at))


@query("select n_nationkey::int as n_nationkey, n_name, n_regionkey::int as n_regionkey from nation")
def commented_csv(spark, sf):
    at = f"{_folder(spark)}/nations.csv"
    rows = testdata.table(spark, sf, "nation").select(F.col("n_nationkey").cast("int"), "n_name", F.col("n_regionkey").cast("int"))
    sinks.csv_with_header(rows, at, ["nations", "with their regions"])
    return archives.read_commented(spark, at, "n_nationkey int, n_name string, n_regionkey int")


@query("select o_orderkey::bigint as o_orderkey, o_orderstatus from orders")
def json_records(spark, sf):
    at = _folder(spark)
    sinks.json_records(testdata.table(spark, sf, "orders").select(F.col("o_orderkey").cast("long"), "o_orderstatus"), at)
    return spark.read.schema("o_orderkey long, o_orderstatus string").json(at)


@query("select 'large' as branch, count(*) as n, 0::bigint as n_notes from orders where o_totalprice > 150000 union all select 'small', count(*), count(*) from orders where o_totalprice <= 150000")
def sink_branches(spark, sf):
    """Two outputs with the union of their columns, appended to and read back."""
    at, orders = _folder(spark), testdata.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    parts = {"large": orders.filter("o_totalprice > 150000"), "small": orders.filter("o_totalprice <= 150000").withColumn("note", F.lit("small"))}
    sinks.branches(parts, at)
    both = [spark.read.parquet(f"{at}/{b}").agg(F.count("*").alias("n"), F.count("note").alias("n_notes")).select(F.lit(b).alias("branch"), "n", "n_notes") for b in parts]
    return both[0].union(both[1])


@query("select o_orderstatus, 2 * count(*) as n, 1::int as n_writes from orders group by 1")
def append_and_skip(spark, sf):
    """A partitioned sink appended to twice, beside a finished one that is not written again."""
    at, orders = _folder(spark), testdata.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    for _ in range(2):
        sinks.parquet(orders, f"{at}/parts", ["o_orderstatus"])
    writes = sum(sinks.once(orders, f"{at}/once") for _ in range(2))
    return spark.read.parquet(f"{at}/parts").groupBy(F.col("o_orderstatus").cast("string").alias("o_orderstatus")).agg(F.count("*").alias("n")).withColumn("n_writes", F.lit(writes))


@query("select 'b' as snapshot_id, count(*) as n, sum(o_orderkey)::bigint as total from orders where o_orderkey % 2 = 1")
def snapshot_latest(spark, sf):
    at, orders = _folder(spark), testdata.table(spark, sf, "orders").select("o_orderkey")
    archives.add_snapshot(orders.filter("o_orderkey % 2 = 0"), at, "a")
    archives.add_snapshot(orders.filter("o_orderkey % 2 = 1"), at, "b")
    archives.add_snapshot(orders, at, "a")
    return archives.snapshot(spark, at).groupBy("snapshot_id").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("total"))


@query("select * from (values " + ", ".join(f"('{r}', '{t.exception_type}', '{t.severity}', {t.weight}::double)" for r, t in C.RULES.items()) + ") t(rule_id, exception_type, severity, weight)")
def rule_catalogue(spark, sf):
    """The rules as JSON and back."""
    found = rules.read_catalogue(rules.catalogue())
    return spark.createDataFrame([(r, t.exception_type, t.severity, float(t.weight)) for r, t in found.items()], "rule_id string, exception_type string, severity string, weight double")


@query(chain("""select loan_id, m, (row_number() over (partition by loan_id order by m) - 1)::int as month_index, (row_number() over (partition by loan_id, run order by m) - 1)::int as unchanged from (
  select *, sum(moved) over (partition by loan_id order by m) as run from (
    select loan_id, mi::int as m, coalesce((abs(current_balance - lag(current_balance) over (partition by loan_id order by mi)) >= 0.01)::int, 1) as moved from mo))""", "mo"))
def stream_run_lengths(spark, sf):
    at = _folder(spark)
    month = (F.year("reporting_month") * 12 + F.month("reporting_month")).cast("int").alias("m")
    dense(spark, sf).monthly.select("loan_id", month, "current_balance").write.parquet(at)
    stream = spark.readStream.schema("loan_id string, m int, current_balance double").parquet(at)
    return finish(streams.run_lengths(stream, "loan_id", "m", "current_balance"))


@query("select user_id, max(event_id)::bigint as event_id from events group by 1")
def stream_upsert(spark, sf):
    """The newest event of each user, kept by a stream that writes each batch in place of itself."""
    at = _folder(spark)
    events = testdata.table(spark, sf, "events").select("user_id", F.col("event_id").cast("long").alias("event_id"))
    events.repartition(3).write.parquet(f"{at}/in")
    put = streams.upsert(f"{at}/out", ["user_id"], "event_id")
    stream = streams.events(spark, f"{at}/in", events.schema.simpleString()[7:-1].replace(":", " "))
    stream.writeStream.option("checkpointLocation", f"{at}/state").trigger(availableNow=True).foreachBatch(put).start().awaitTermination()
    return streams.current(spark, f"{at}/out", ["user_id"], "event_id")


# Answers and projections from known scores.

_DATE = f"R003: {C.RULES['R003'].description}".replace("'", "''")


@query(f"""with s as (select c_custkey, (c_custkey % 100) / 100 as p3, (c_custkey % 40) / 200 as pd, (c_custkey % 10) / 50 as pp, (c_custkey % 11) / 10 as a from customer),
j as (select s_suppkey::varchar as loan_id, s.*, c_custkey is null as unknown from supplier left join s on c_custkey = s_suppkey and c_custkey % 4 <> 0),
f as (select *, case when unknown then 0.05 else pd end as d, not unknown and (a > 0.5 or pd > 0.1) as odd from j)
select loan_id, round(case when unknown then 0.15 else p3 end, 6) as next_3m_delinquency_prob, round(d, 6) as next_12m_default_prob, round(case when unknown then 0.2 else pp end, 6) as next_12m_prepayment_prob, odd as is_anomaly,
  'Reviewer summary for loan ' || loan_id || ': default probability ' || format('{{:.1f}}', d * 100) || '%. ' || case when not odd then 'No anomalies detected.' else 'Warning: the anomaly detector flagged this record.'
    || case when c_custkey % 3 = 0 then ' High risk drivers: dti, ltv.' else '' end || case when c_custkey % 7 = 0 then ' Specific rule violations found: {_DATE}.' else '' end end as reviewer_summary from f""")
def batch_answers(spark, sf):
    """Submission and answers for known and unknown loans, from scores that are known."""
    k = F.col("c_custkey")
    driver = lambda n: F.struct(F.lit(n).alias("feature"), F.lit(0.5).alias("contribution"), F.lit("increases").alias("effect"))
    none = F.array().cast("array<struct<feature:string,contribution:double,effect:string>>")
    scored = testdata.table(spark, sf, "customer").filter(k % 4 != 0).select(
        k.cast("string").alias("loan_id"), (k % 100 / 100).alias("next_3m_delinquency_flag"), (k % 40 / 200).alias("next_12m_default_flag"), (k % 10 / 50).alias("next_12m_prepayment_flag"),
        F.lit("Current").alias("predicted_state"), F.lit(0.5).alias("confidence"), F.when(k % 3 == 0, F.array(driver("dti"), driver("ltv"))).otherwise(none).alias("drivers"),
        (k % 11 / 10).alias("anomaly_score"), F.when(k % 7 == 0, "date_conflict").alias("exception_type"))
    out = serve.submission(scored, ["next_3m_delinquency_flag", "next_12m_default_flag", "next_12m_prepayment_flag"])
    return rounded(serve.predict(testdata.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("loan_id")), out))


@query(chain("""select loan_id, step::int as step, round(least(0.5, 0.0005 * (age + step - 1)), 6) as hazard, round(exp(sum(ln(1 - least(0.5, 0.0005 * (age + step - 1)))) over (partition by loan_id order by step)), 6) as survival
  from (select loan_id, max(loan_age_months) as age from mo group by 1), range(1, 13) t(step)""", "mo"))
def hazard_projection(spark, sf):
    """Twelve months ahead from a known hazard that rises with age, a decimal as in its SQL: many second steps end in a five after six digits."""
    last = segments.latest(dense(spark, sf).monthly.select("loan_id", "reporting_month", "loan_age_months")).select("loan_id", "loan_age_months")
    hazard = F.least(F.lit(Decimal("0.5")), F.lit(Decimal("0.0005")) * F.col("loan_age_months"))
    return rounded(survival.curves(last, lambda d: d.withColumn("score", hazard), 12), to=S.round_scaled)
