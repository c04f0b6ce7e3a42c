import datetime as dt
import zlib

import pytest
from pyspark.sql import functions as F

from panelyard.functions import scalar as S
from panelyard.plans import contract as C


def column(spark, values, make, kind="string"):
    rows = spark.createDataFrame([(i, float(v) if kind == "double" and v is not None else v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in rows.select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize("code,months", [("00", 0), ("01", 1), ("02", 2), ("03", 3), ("06", 6), ("12", 12), ("XX", None), ("", None), (" 01 ", 1), ("xx", None), ("0", 0), (None, None), ("1.5", None)])
def test_delinquency(spark, code, months):
    assert column(spark, [code], S.delinquency_months) == [months]


def status(spark, rows, k=C.DEFAULT_MONTHS):
    df = spark.createDataFrame(rows, "m int, z string")
    return [r.asDict() for r in df.select(*[v.alias(n) for n, v in S.status(F.col("m"), F.col("z"), k).items()]).collect()]


def test_status(spark):
    rows = [(0, None), (1, None), (3, None), (6, None), (0, "01"), (2, "01"), (0, "02"), (0, "03"), (0, "09"), (0, "15"), (8, "09"), (0, "06"), (0, "16"), (None, None), (0, "77"), (7, "01"), (0, " 01 ")]
    got = status(spark, rows)
    assert [r["current_status"] for r in got] == [
        "Current", "Delinquent", "Delinquent", "Default", "Prepaid", "Prepaid", "Default", "Default", "Default", "Default", "Default", "Closed", "Closed", "Current", "Closed", "Prepaid", "Prepaid"]
    assert set(r["current_status"] for r in got) <= set(C.STATES)
    assert got[3]["default_flag"] and got[3]["delinquency"] and not got[2]["default_flag"]
    assert got[4]["termination_reason"] == "prepaid_or_matured" and got[4]["is_terminated"] and got[5]["delinquency"]
    assert not got[11]["default_flag"] and not got[11]["prepayment_flag"] and got[14]["termination_reason"] is None
    assert got[15]["default_flag"] and got[15]["prepayment_flag"]
    assert not any(got[13][c] for c in ("delinquency", "default_flag", "prepayment_flag", "is_terminated"))
    assert [status(spark, [(3, None)], k)[0]["default_flag"] for k in (3, 6)] == [True, False]


def test_months(spark):
    got = column(spark, ["022018", "122025", "012018", "", "2018", "1320188", "992018", None, " 022018 "], S.parse_month)
    assert got == [dt.date(2018, 2, 1), dt.date(2025, 12, 1), dt.date(2018, 1, 1), None, None, None, None, None, dt.date(2018, 2, 1)]


def test_bands(spark):
    assert column(spark, [690, 700, 575, 800, None, 851, -1, 580], lambda c: S.band(c, C.CREDIT_BANDS), "double") == ["680-699", "700-719", "<580", "780+", "Unknown", "Unknown", "Unknown", "580-619"]
    assert column(spark, [85, 80, 98, None], lambda c: S.band(c, C.LTV_BANDS), "double") == ["85-90", "80-85", "97+", "Unknown"]
    assert column(spark, [40, 19, None], lambda c: S.band(c, C.DTI_BANDS), "double") == ["36-43", "<20", "Unknown"]


def test_conversions(spark):
    assert column(spark, [" 1.5 ", "x", "", None, "-2"], S.to_number) == [1.5, None, None, None, -2.0]
    assert column(spark, [" a ", "", " ", None], S.clean_category) == ["a", "Unknown", "Unknown", "Unknown"]
    assert column(spark, ["P", " C", "Z", "", None], lambda c: S.decode(c, C.PURPOSE)) == ["purchase", "cash_out_refinance", "Unknown", "Unknown", "Unknown"]
    assert column(spark, [None, 5.0, -1.0, 2.0], lambda c: S.clip(c, 0, 3), "double") == [None, 3.0, 0.0, 2.0]
    assert column(spark, [4.0, None], lambda c: S.ratio(c, c * 0), "double") == [None, None]
    assert column(spark, [0.0, 0.02, 0.1, 0.25, None], lambda c: S.level(c, C.RISK_LEVELS), "double") == ["low", "medium", "high", "critical", None]


def splitmix(x):
    m = (1 << 64) - 1
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & m
    x = (x ^ x >> 27) * 0x94D049BB133111EB & m
    return (x ^ x >> 31) % 1_000_000


def test_hash(spark):
    ids = ["0", "1", "123456789012", "x", None, "9007199254740993", "  77 "]
    seed = zlib.crc32(b"salt")
    want = [splitmix(n + seed) for n in (0, 1, 123456789012, 0, 0, 9007199254740993, 77)]
    assert column(spark, ids, lambda c: S.hash_bucket(c, "salt")) == want
    kept = column(spark, [str(i) for i in range(20000)], lambda c: S.sampled(c, 0.1, "salt"))
    assert 0.09 < sum(kept) / len(kept) < 0.11 and all(column(spark, ["5"], lambda c: S.sampled(c, 1.0, "salt")))
