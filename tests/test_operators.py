import datetime as dt
import importlib
import sys
import zipfile
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from panelyard.operators import anomaly, explain, metrics, models, scenario, segments, serve, survival
from panelyard.operators.registry import Registry
from panelyard.plans import contract as C
from panelyard.plans.exchange import ORACLES, QUERIES
from panelyard.sources import archives, sinks
from panelyard.streaming import panel as streams
from panelyard.streaming.runs import finish


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(900):
        x, z = rng.normal(), rng.normal()
        y = int(rng.random() < 1 / (1 + np.exp(-(2 * x - 1))))
        rows.append((f"l{i}", ("train", "validation", "test")[i % 3], float(x), None if i % 11 == 0 else float(z), y, 1, "AB"[int(x > 0)] if i % 5 else "C"))
    return spark.createDataFrame(rows, "loan_id string, split string, x double, z double, y int, y_complete int, next_state string").withColumn("next_state_complete", F.lit(1)).cache()


@pytest.fixture(scope="module")
def bundle(labelled):
    return models.train(*[models.load_split(labelled, s, "y", ["loan_id"]) for s in ("train", "validation")], "y", ["x", "z"])


def test_models(labelled, bundle, tmp_path):
    out = bundle.score(labelled)
    assert out.filter("score < 0 or score > 1 or score is null").isEmpty()
    registry = Registry(labelled.sparkSession, f"file://{tmp_path}/models")
    found = models.compare(labelled, "y", ["x", "z"], ["loan_id"], ("logistic_regression", "random_forest"), trees=5, registry=registry)
    assert {f["algorithm"] for f in found} == {"logistic_regression", "random_forest"} and found[0]["pr_auc"] >= found[1]["pr_auc"] and found[0]["roc_auc"] > 0.8
    assert sorted(tuple(r) for r in registry.standing().select("version", "stage").collect()) == [(1, "staging"), (2, "staging")]
    assert registry.find("y_model", "staging") == 2 and registry.find("y_model") == 2
    again = registry.load("y_model", 1).score(labelled).select("loan_id", "score")
    assert again.count() == 900 and registry.load("y_model", 1) is registry.load("y_model", 1)
    best = 1 if found[0]["algorithm"] == "logistic_regression" else 2
    assert registry.put_up("y_model", best).granted and not registry.put_up("y_model", 3 - best, gain=0.5).granted
    assert registry.find("y_model") == best and registry.put_up("y_model", 3 - best, gain=None).holder == best
    assert {r.version: r.stage for r in registry.standing().collect()} == {best: "archived", 3 - best: "production"} and registry.find("y_model") == 3 - best
    assert registry.put_up("y_model", best, gain=None).granted and registry.find("y_model") == best and registry.events().count() == 5
    with pytest.raises(KeyError):
        registry.put_up("y_model", 9)
    with pytest.raises(KeyError):
        registry.find("none")


def test_platt_and_few_positives(labelled):
    parts = [models.load_split(labelled, s, "y", ["loan_id"], cap=200) for s in ("train", "validation")]
    scored = models.train(*parts, "y", ["x", "z"], calibrate="platt").score(labelled)
    assert scored.filter("score > 0 and score < 1").count() == 900
    assert models.compare(labelled.withColumn("y", F.lit(0)), "y", ["x"], ["loan_id"]) == []


def test_states(labelled):
    got = models.train_states(labelled.filter("split = 'train'"), ["x", "z"], "logistic_regression").score(labelled)
    assert {r[0] for r in got.select("predicted_state").distinct().collect()} <= {"A", "B", "C"} and got.filter("confidence <= 0 or confidence > 1").isEmpty()


@pytest.mark.parametrize("algorithm", ["logistic_regression", "random_forest", "gradient_boosting"])
def test_explanations_add_up(spark, labelled, algorithm):
    parts = [models.load_split(labelled, s, "y", ["loan_id"]) for s in ("train", "validation")]
    b = models.train(*parts, "y", ["x", "z"], algorithm, trees=8, calibrate="none")
    rows = {r.loan_id: {d.feature: d.contribution for d in r.drivers} for r in explain.explain(labelled, b, ["loan_id"]).collect()}
    raw = {r.loan_id: r._p for r in b.raw(labelled).select("_row.loan_id", "_p").collect()}
    link = {"logistic_regression": lambda p: np.log(p / (1 - p)), "random_forest": lambda p: p, "gradient_boosting": lambda p: np.log(p / (1 - p)) / 2}[algorithm]
    rest = [link(raw[i]) - sum(d.values()) for i, d in rows.items()]
    assert np.ptp(rest) < 1e-6 and len(rows) == 900
    assert models.importances(b)[0][0] == "x"


def test_forest(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(a), float(b), 0) for i, (a, b) in enumerate(rng.normal(0, 1, (400, 2)))] + [(900, 9.0, -9.0, 0), (901, None, float("inf"), 1)]
    df = spark.createDataFrame(rows, "id int, a double, b double, n_hard_failures int").withColumn("dq_penalty", F.when(F.col("id") == 5, 150.0).otherwise(0.0)).withColumn("exception_type", F.when(F.col("id") == 5, "date_conflict"))
    forest, middle = anomaly.fit(df, ["a", "b"], ["id"], trees=40)
    got = {r.id: r for r in anomaly.score(df, forest, middle, ["a", "b"]).collect()}
    assert got[900].ml_anomaly_score == 1.0 and got[900].exception_type == "statistical_outlier" and got[5].anomaly_score == 1.0 and got[5].exception_type == "date_conflict" and len(got) == 402
    again, _ = anomaly.fit(df, ["a", "b"], ["id"], trees=40)
    assert np.allclose(again.score(np.zeros((1, 2))), forest.score(np.zeros((1, 2))))
    drivers = {r.id: r.drivers for r in anomaly.drivers(df, ["a", "b", "n_hard_failures"], ["id"]).collect()}
    assert [d.field for d in drivers[901]] == ["b"] and len(drivers[900]) == 2 and drivers[900][0].robust_z >= drivers[900][1].robust_z


def test_examples(spark):
    rows = [(i, "x" if i < 50 else "y" if i < 53 else None, i / 100) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, exception_type string, anomaly_score double")
    got = anomaly.examples(df, ["id"], 20).collect()
    assert len(got) == 20 and {r.exception_type for r in got} == {"x", "y", None} and all(r.recommendation for r in got)
    assert anomaly.summary(df).first().n_anomalies == 9


def test_scenarios(spark):
    df = spark.createDataFrame([("a", 4.0, 0.0, "TX"), ("b", 5.0, 30.0, None)], "loan_id string, current_interest_rate double, days_past_due double, state string")
    score = lambda d: d.withColumn("score", F.col("current_interest_rate") / 100 + F.col("days_past_due") / 300)
    got = {r.scenario_name: r.portfolio_rate for r in scenario.simulate(df, scenario.scenarios(spark), "next_12m_default_flag", score).collect()}
    assert got["base"] == pytest.approx((0.04 + 0.15) / 2) and got["adverse_credit"] == pytest.approx(2.6 * (0.0401 + 0.1 + 0.0501 + 0.2) / 2) and got["high_prepayment"] == pytest.approx(0.75 * (0.03985 + 0.14985) / 2)
    own = scenario.scenarios(spark, {"base": {"default_multiplier": 99.0}})
    assert {r.scenario_name: r.portfolio_rate for r in scenario.simulate(df, own, "next_12m_default_flag", score).collect()}["base"] == 1.0
    by = scenario.simulate(df, scenario.scenarios(spark), "next_12m_prepayment_flag", score, ["state"]).collect()
    assert len(by) == 9
    assert scenario.compare(scenario.simulate(df, scenario.scenarios(spark), "x", score)).first().adverse_credit_delta == pytest.approx(got["adverse_credit"] - got["base"])


def test_survival(spark):
    lives = spark.createDataFrame([("a", 1, 0, 0), ("b", 2, 1, 0), ("c", 2, 0, 1), ("d", 3, 1, 0)], "loan_id string, age int, event int, entry int")
    got = {r.age: r for r in survival.kaplan_meier(lives).collect()}
    assert got[2].at_risk == 3 and got[2].survival == pytest.approx(2 / 3) and got[3].survival == 0.0 and got[3].incidence == 1.0
    curve = survival.curves(spark.createDataFrame([("a", 10)], "loan_id string, loan_age_months int"), lambda d: d.withColumn("score", F.lit(0.1)), 3).orderBy("step").collect()
    assert [r.survival for r in curve] == pytest.approx([0.9, 0.81, 0.729])


def test_hazard_projection_equals_its_sql(spark, tmp_path):
    """Ages up to 112: the products of two hazards of four decimals often end in a five after six."""
    months = spark.range(1, 361).selectExpr("id as l_suppkey", "'N' as l_returnflag", "explode(sequence(date'2010-01-01', add_months(date'2010-01-01', cast(id % 90 as int)), interval 1 month)) as l_shipdate")
    months.write.parquet(f"{tmp_path}/lineitem.parquet")
    db = duckdb.connect()
    db.execute(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    want = {r[:2]: (float(r[2]), r[3]) for r in db.execute(ORACLES["hazard_projection"]).fetchall()}
    assert {r[:2]: r[2:] for r in map(tuple, QUERIES["hazard_projection"](spark, str(tmp_path)).collect())} == want and len(want) == 360 * 12


def test_survival_to_the_last_bit(spark):
    rows = spark.range(1000).selectExpr("cast(id as string) as loan_id", "cast(id as int) as loan_age_months")
    got = survival.curves(rows, lambda d: d.withColumn("score", F.col("loan_age_months") / 2000), 3).collect()
    want = duckdb.sql("select a::varchar, step::int, exp(sum(ln(1 - (a + step - 1)::double / 2000)) over (partition by a order by step)) from range(1000) s(a), range(1, 4) t(step)").fetchall()
    assert {(r.loan_id, r.step): r.survival for r in got} == {r[:2]: r[2] for r in want}


def test_segments(spark):
    df = spark.createDataFrame([("a", dt.date(2020, 1, 1), "Current", 1.0), ("a", dt.date(2020, 2, 1), "Delinquent", 2.0), ("b", dt.date(2020, 3, 1), "Current", 3.0)], "loan_id string, reporting_month date, current_status string, current_balance double")
    assert [tuple(r) for r in segments.transitions(df).collect()] == [("Current", "Delinquent", 1, 1.0)]
    assert {r.loan_id: r.current_balance for r in segments.latest(df).collect()} == {"a": 2.0, "b": 3.0}
    asked = spark.createDataFrame([("a", dt.date(2020, 1, 15)), ("b", dt.date(2020, 1, 1)), ("z", dt.date(2020, 1, 1))], "loan_id string, as_of date")
    assert {r.loan_id: r.current_status for r in segments.as_of(df, asked).collect()} == {"a": "Current", "b": None, "z": None}


def test_serving(spark):
    loans = spark.createDataFrame([(f"l{i:02d}", "TX" if i % 2 else "CA") for i in range(30)], "loan_id string, state string")
    assert [r.loan_id for r in serve.page(loans, [F.col("loan_id")], 2, 10).collect()] == [f"l{i}" for i in range(10, 20)]
    assert serve.page(loans, [F.col("loan_id")], 1, 999).count() == 30 and [r.loan_id for r in serve.after(loans, "loan_id", "l27").collect()] == ["l28", "l29"] and serve.after(loans, "loan_id", None, 3).count() == 3
    sub = spark.createDataFrame([("l01", '{"next_12m_default_flag":0.3}', 0.1, "Review", "date_conflict", '[{"feature":"x","contribution":1.0,"effect":"increases"}]')], "loan_id string, probabilities string, anomaly_score double, action string, exception_type string, drivers string")
    got = {r.loan_id: r for r in serve.predict(loans.filter("loan_id in ('l01', 'l02')"), sub).collect()}
    assert got["l01"].is_anomaly and got["l01"].next_12m_default_prob == 0.3 and got["l01"].next_3m_delinquency_prob == 0.0 and "R003: " + C.RULES["R003"].description in got["l01"].reviewer_summary and "drivers: x." in got["l01"].reviewer_summary
    assert got["l02"].next_12m_default_prob == 0.05 and got["l02"].reviewer_summary.endswith("No anomalies detected.") and not got["l02"].is_anomaly


def raw_line(loan, month, **named):
    at = {f.name: i for i, f in enumerate(C.LAYOUT)}
    parts = [""] * 113
    for k, v in ({"LOAN_ID": loan, "ACT_PERIOD": month} | named).items():
        parts[at[k]] = v
    return "|".join(parts)


def test_archives(spark, tmp_path):
    lines = [raw_line(f"10000000{i}", "012020", CURRENT_UPB="5.5", SELLER='a "q" b') for i in range(5)]
    (tmp_path / "txt").mkdir()
    (tmp_path / "txt" / "a.csv").write_text("\n".join(lines) + "\n")
    got = archives.read_delimited(spark, str(tmp_path / "txt"))
    assert got.count() == 5 and got.first().SERVICER == "" and got.first().SELLER == 'a "q" b' and got.columns == [*C.PARSED, "source_file"]
    zips = tmp_path / "zips"
    zips.mkdir()
    for n in ("x", "y"):
        with zipfile.ZipFile(zips / f"{n}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("one.csv", "\n".join(lines) + "\n")
    with zipfile.ZipFile(zips / "bad.zip", "w") as z:
        z.writestr("1", "a")
        z.writestr("2", "b")
    found = {r.path.rsplit("/", 1)[1]: r for r in archives.describe(spark, str(zips)).collect()}
    assert found["x.zip"].member == "one.csv" and found["x.zip"].ratio > 1 and "found 2" in found["bad.zip"].problem
    assert archives.corpus_summary(archives.describe(spark, str(zips)).filter("problem is null")).first().n_archives == 2
    (zips / "bad.zip").unlink()
    read = archives.read_zips(spark, str(zips), ("LOAN_ID", "CURRENT_UPB"))
    assert read.count() == 10 and read.first().CURRENT_UPB == "5.5" and read.first().LOAN_ID == "100000000"
    with zipfile.ZipFile(tmp_path / "short.zip", "w") as z:
        z.writestr("one.csv", lines[0] + "\n" + "a|b\n")
    (tmp_path / "bad").mkdir()
    (tmp_path / "short.zip").rename(tmp_path / "bad" / "short.zip")
    with pytest.raises(Exception, match="113"):
        archives.read_zips(spark, str(tmp_path / "bad"), ("LOAN_ID",)).count()
    assert archives.verify_contract(spark.createDataFrame([(x,) for x in lines], "value string")) == []
    assert len(archives.verify_contract(spark.createDataFrame([("a||c",), ("|1|22",)], "value string"))) == 4
    base = archives.manifest(spark, str(zips))
    base = spark.createDataFrame(base.collect(), base.schema)
    assert archives.verify_manifest(base, None)[0] == "baseline_created" and archives.verify_manifest(archives.manifest(spark, str(zips)), base)[0] == "verified"
    (zips / "y.zip").unlink()
    (zips / "x.zip").write_bytes(b"other")
    state, changed = archives.verify_manifest(archives.manifest(spark, str(zips)), base)
    assert state == "MODIFIED" and {tuple(r) for r in changed.collect()} == {("x.zip", "changed"), ("y.zip", "missing")}
    assert archives.peek(spark, str(tmp_path / "txt"), 2).count() == 2


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i int, s string")
    at = str(tmp_path / "x")
    assert sinks.once(df, at) and not sinks.once(df, at) and sinks.completed(spark, at) and not sinks.completed(spark, at + "none")
    sinks.branches({"p": df, "q": df.select(F.lit(1.5).alias("z"), "i")}, str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b" / "p")).columns == spark.read.parquet(str(tmp_path / "b" / "q")).columns == ["i", "s", "z"]
    assert sinks.csv_with_header(df, str(tmp_path / "c.csv"), ["made by a test"]) == 2
    assert archives.read_commented(spark, str(tmp_path / "c.csv"), "i int, s string").count() == 2
    sinks.json_records(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    sinks.parquet(df, str(tmp_path / "k"), ["i"])
    sinks.parquet(df, str(tmp_path / "k"), ["i"])
    assert spark.read.parquet(str(tmp_path / "k")).count() == 4
    assert "| 1 | a |" in sinks.markdown("t", {"rows": df})


def test_streams(spark, tmp_path):
    at = str(tmp_path / "in")
    schema = "loan_id string, m int, bal double"
    spark.createDataFrame([("a", 0, 5.0), ("a", 1, 5.0), ("b", 0, 1.0)], schema).coalesce(1).write.mode("append").parquet(at)
    spark.createDataFrame([("a", 2, 5.0), ("a", 3, 6.0), ("b", 1, 2.0)], schema).coalesce(1).write.mode("append").parquet(at)
    got = finish(streams.run_lengths(streams.events(spark, at, schema), "loan_id", "m", "bal")).collect()
    assert {(r.loan_id, r.m): (r.month_index, r.unchanged) for r in got} == {("a", 0): (0, 0), ("a", 1): (1, 1), ("a", 2): (2, 2), ("a", 3): (3, 0), ("b", 0): (0, 0), ("b", 1): (1, 0)}
    put = streams.upsert(str(tmp_path / "up"), ["loan_id"], "m")
    put(spark.createDataFrame([("a", 0, 1.0), ("a", 1, 2.0)], schema), 0)
    put(spark.createDataFrame([("a", 1, 2.5), ("b", 0, 1.0)], schema), 1)
    put(spark.createDataFrame([("a", 1, 2.5), ("b", 0, 1.0)], schema), 1)
    assert {r.loan_id: r.bal for r in streams.current(spark, str(tmp_path / "up"), ["loan_id"], "m").collect()} == {"a": 2.5, "b": 1.0}


def test_entry(spark):
    entry = importlib.import_module("__spark_entry__")
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 100


@pytest.fixture(scope="module")
def tables(sf):
    db = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        db.execute(f"create view {p.stem} as select * from '{p}'")
    return db


@pytest.mark.parametrize("name", list(QUERIES))
def test_registered_query(spark, sf, tables, name):
    """Every query ends, and has as many rows and the columns of its SQL."""
    got = QUERIES[name](spark, sf)
    rows = got.count()
    if name in ORACLES:
        want = tables.execute(ORACLES[name])
        assert sorted(got.columns) == sorted(c[0] for c in want.description) and rows == len(want.fetchall())
    else:
        assert rows > 0


def test_advice_is_for_every_exception():
    assert set(anomaly.RECOMMENDATIONS) == {t.exception_type for t in C.RULES.values()} | {"statistical_outlier"}


def test_snapshots(spark, tmp_path):
    at = f"{tmp_path}/snapshots"
    one, two = (spark.createDataFrame([(i, n)], "i int, n string") for i, n in ((1, "a"), (2, "b")))
    assert archives.add_snapshot(one, at, "2024-01") and archives.add_snapshot(two, at, "2024-02") and not archives.add_snapshot(two, at, "2024-01")
    assert [tuple(r) for r in archives.snapshot(spark, at).collect()] == [(2, "b", "2024-02")] and archives.snapshot(spark, at, "2024-01").first().i == 1


def test_bands_and_best_states(labelled, bundle):
    parts = [models.load_split(labelled, s, "y", ["loan_id"]) for s in ("train", "validation")]
    other = models.train(*parts, "y", ["x", "z"], "random_forest", trees=5)
    rows = models.spread([bundle, other], labelled, ["loan_id"]).collect()
    assert len(rows) == 900 and all(0 <= r.low <= r["mean"] <= r.high <= 1 for r in rows) and any(r.low < r.high for r in rows)
    best, found = models.best_states(labelled.filter("split = 'train'"), labelled.filter("split = 'validation'"), ["x", "z"], trees=5)
    assert set(found) == {"logistic_regression", "random_forest"} and max(found.values()) > 0.3
    auc = {r.label: r.auc for r in metrics.one_vs_rest(best.score(labelled), "next_state", "state_probabilities").collect()}
    assert set(auc) == {"A", "B", "C"} and auc["A"] > 0.7 and auc["B"] > 0.7


def test_reviewed_anomalies(spark):
    rows = spark.createDataFrame([("a", 1, 0.9, "x", ""), ("b", 1, 0.8, "x", ""), ("c", 1, 0.1, "x", "")], "loan_id string, reporting_month int, anomaly_score double, exception_type string, reason string")
    done = rows.filter("loan_id = 'a'").select("loan_id", "reporting_month")
    assert [r.loan_id for r in serve.anomalies(rows, 0.5, reviewed=True, reviews=done).collect()] == ["a"]
    assert [r.loan_id for r in serve.anomalies(rows, 0.5, reviewed=False, reviews=done).collect()] == ["b"]


def test_entry_imports_without_the_text_operators(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("panelyard.llm") or m in ("__spark_entry__", "corpus_pipeline")]:
        monkeypatch.delitem(sys.modules, name)
    import panelyard

    monkeypatch.delattr(panelyard, "llm", raising=False)
    monkeypatch.setitem(sys.modules, "panelyard.llm", None)
    entry = importlib.import_module("__spark_entry__")
    assert "population_monthly" in entry.queries() and not any(q.startswith("op") for q in entry.queries())
