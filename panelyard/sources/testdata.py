"""Monthly panels built from the star-schema test tables, as raw records.

The dense panel has one row for each supplier and shipping month; every other raw
field follows from integer arithmetic on the supplier key and the row's place, so the SQL
twins in ``plans/oracle.py`` can state the same values independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_STATE = "element_at(array('', 'TX', 'CA', 'NY', 'FL', 'OH', 'WA', 'IL'), cast(k % 8 as int) + 1)"
_X = "case when k % 3 = 0 then nr - 3 when k % 10 = 5 then idx div 6 - 4 else nr - 6 end"
_ZB = "element_at(array('', '01', '02', '03', '06', '09', '15', '16'), cast(k % 8 as int) + 1)"
_ENDS = "((k % 29 <> 4 and m = last) or (k % 29 = 4 and idx = 60))"
#: Raw field: SQL over k (supplier), m (month), idx (row of the supplier), mi (month number), nr (returned lines), orig, term, m0, last.
RAW = {
    "LOAN_ID": "cast(k as string)", "ACT_PERIOD": "date_format(m, 'MMyyyy')",
    "CHANNEL": "element_at(array('R', 'C', 'B', 'X'), cast(k % 4 as int) + 1)", "SELLER": "concat('Seller ', k % 7)",
    "SERVICER": "concat(' Servicer ', (k + idx div 24) % 5)", "ORIG_RATE": "format_string('%d.%02d', (300 + k * 11 % 400) div 100, (300 + k * 11 % 400) % 100)",
    "CURR_RATE": "format_string('%d.%02d', r div 100, r % 100)", "ORIG_UPB": "concat(orig, '.00')", "CURRENT_UPB": "concat(bal, '.00')",
    "ORIG_TERM": "cast(term as string)", "ORIG_DATE": "date_format(om, 'MMyyyy')", "LOAN_AGE": "cast(idx + k % 24 as string)",
    "REM_MONTHS": "cast(term - idx + if(k % 19 = 5 and idx < 3, 6, 0) as string)", "MATR_DT": "''",
    "OLTV": "if(k % 13 = 0, '', cast(40 + k * 13 % 65 as string))", "OCLTV": "if(k % 13 = 0, '', cast(40 + k * 13 % 65 + k % 3 as string))",
    "NUM_BO": "cast(1 + k % 3 as string)", "DTI": "if(k % 13 = 0, '', cast(10 + k * 7 % 50 as string))",
    "CSCORE_B": "if(k % 13 = 0, '', cast(500 + k * 37 % 351 as string))", "CSCORE_C": "if(k % 4 = 0, cast(520 + k * 29 % 300 as string), '')",
    "FIRST_FLAG": "if(k % 2 = 0, 'Y', 'N')", "PURPOSE": "element_at(array('P', 'C', 'R', 'U', ''), cast(k % 5 as int) + 1)",
    "PROP": "element_at(array('SF', 'PU', 'CO', 'CP', 'MH', 'ZZ'), cast(k % 6 as int) + 1)", "NO_UNITS": "cast(1 + k % 4 as string)",
    "OCC_STAT": "element_at(array('P', 'I', 'S', 'U'), cast(k div 4 % 4 as int) + 1)", "STATE": _STATE, "MSA": "cast(10000 + k % 50 as string)",
    "ZIP": "lpad(cast(k * 17 % 1000 as string), 3, '0')", "MI_PCT": "if(k % 3 = 0, cast(k % 30 as string), '')", "PRODUCT": "'FRM'",
    "DLQ_STATUS": f"if((k + mi) % 11 = 0, 'XX', lpad(cast(greatest(0, {_X}) as string), 2, '0'))", "MOD_FLAG": "if(k % 31 = 6 and idx >= 10, 'Y', 'N')",
    "Zero_Bal_Code": f"if({_ENDS}, {_ZB}, '')", "ZB_DTE": f"if({_ENDS} and k % 8 <> 0, date_format(m, 'MMyyyy'), '')",
    "LAST_UPB": f"if({_ENDS}, concat(bal, '.00'), '')", "TOT_SCHD_PRNCPL": "cast(100 + k % 400 as string)",
    "LAST_PAID_INSTALLMENT_DATE": "if(k % 2 = 0, date_format(add_months(m, -1), 'MMyyyy'), '')", "NON_INTEREST_BEARING_UPB": "concat(k % 5 * 100, '.00')",
    "PRINCIPAL_FORGIVENESS_AMOUNT": "''", "MI_TYPE": "element_at(array('1', '2', '3', ''), cast(k % 4 as int) + 1)", "SERV_IND": "'N'",
    "HOMEREADY_PROGRAM_INDICATOR": "if(k % 9 = 0, 'H', '')", "HIGH_BALANCE_LOAN_INDICATOR": "if(k % 10 = 0, 'Y', 'N')",
    "FORBEARANCE_INDICATOR": "case when k % 6 = 0 and (k + mi) % 10 < 2 then 'F' when k % 6 = 1 then 'N' when k % 6 = 2 then '7' else '' end", "ADR_TYPE": "''",
}
_BALANCE = """case when idx = 0 then 0 when k % 17 = 3 and idx in (2, 3) then orig * 102 div 100
    when k % 13 = 1 and idx % 9 = 4 then orig * 99 div 100 else orig * greatest(0, 100 - 9 * (idx div 8)) div 100 end"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_panel(spark: SparkSession, sf_dir: str, key: str = "l_suppkey") -> DataFrame:
    """Raw string records of the dense panel (``l_suppkey``) or the large sparse one (``l_partkey``)."""
    month = F.trunc(F.col("l_shipdate").cast("date"), "MM")
    cells = table(spark, sf_dir, "lineitem").groupBy(F.col(key).alias("k"), month.alias("m")).agg(F.count_if(F.col("l_returnflag") == "R").alias("nr"))
    w, all_ = Window.partitionBy("k").orderBy("m"), Window.partitionBy("k")
    base = cells.select(
        "k", "m", "nr", (F.row_number().over(w) - 1).cast("long").alias("idx"), (F.year("m") * 12 + F.month("m")).cast("long").alias("mi"),
        F.min("m").over(all_).alias("m0"), F.max("m").over(all_).alias("last"),
        (100000 + F.col("k") * 7919 % 900000).alias("orig"), (72 + 12 * (F.col("k") % 25)).alias("term"))
    derived = base.selectExpr(
        "*", f"{_BALANCE} as bal", "300 + k * 11 % 400 - if(k % 31 = 6 and idx >= 10, 50, 0) as r",
        "if(k % 23 = 2, add_months(m0, 2), add_months(m0, -cast(k % 24 as int))) as om")
    return derived.selectExpr(*[f"{sql} as {name}" for name, sql in RAW.items()], "concat('part', k % 4) as source_file", "k * 1000 + idx as ingest_seq")


def feed(monthly: DataFrame) -> DataFrame:
    """A second servicer feed over part of the panel; now and then its status is one step further."""
    k, mi = F.col("loan_id").cast("long"), F.year("reporting_month") * 12 + F.month("reporting_month")
    steps = F.array(*[F.lit(s) for s in ("Current", "Delinquent", "Default", "Prepaid", "Closed")])
    moved = F.element_at(steps, (F.array_position(steps, F.col("current_status")) % 5 + 1).cast("int"))
    conflict = (k + mi) % 17 == 0
    return monthly.filter((k * 31 + mi) % 20 < 3).select(
        "loan_id", "reporting_month", F.when(conflict, moved).otherwise(F.col("current_status")).alias("feed_status"),
        F.col("days_past_due").alias("feed_days_past_due"), F.date_add(F.last_day("reporting_month"), ((k + mi) % 40).cast("int")).alias("last_updated_on"),
        F.concat(F.lit("servicer_"), k % 3).alias("source_system"), ((k + mi) % 19 == 0).alias("is_stale"))
