"""Discrete-time survival: hazards by age, curves, incidence and an unconditional baseline."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelyard.functions import scalar as S


def durations(panel: DataFrame, event: str = "default_flag", keep: list[str] = ()) -> DataFrame:
    """One row for each entity: its age at the first event, or its last age, censored."""
    return panel.groupBy("loan_id", *keep).agg(
        F.coalesce(F.min(F.when(F.col(event), F.col("loan_age_months"))), F.max("loan_age_months")).alias("age"), F.max(F.col(event).cast("int")).alias("event"), F.min("loan_age_months").alias("entry"))


def kaplan_meier(lives: DataFrame, by: list[str] = ()) -> DataFrame:
    """(by, age, at_risk, events, hazard, survival, incidence) with late entry and right-censoring.

    Ages are few, so the curve itself is small however many entities there are.
    """
    by = list(by)
    ends = lives.groupBy(*by, "age").agg(F.count("*").alias("leaving"), F.sum("event").alias("events"))
    starts = lives.groupBy(*by, F.col("entry").alias("age")).agg(F.count("*").alias("entering"))
    both = ends.join(starts, [*by, "age"], "full").select(*by, "age", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("leaving", "events", "entering")])
    w = Window.partitionBy(*by).orderBy("age")
    risk = F.sum("entering").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.coalesce(F.sum("leaving").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    hazard = F.coalesce(S.ratio(F.col("events").cast("double"), F.col("at_risk").cast("double")), F.lit(0.0))
    rows = both.withColumn("at_risk", risk).withColumn("hazard", hazard)
    return with_survival(rows, by, "age").withColumn("incidence", 1 - F.col("survival"))


def _products(lists: pa.Array) -> pa.Array:
    """The running products of every list, by sums of logarithms taken in order."""
    logs, ends = pc.ln(lists.flatten()).to_numpy(), np.cumsum(pc.list_value_length(lists).to_numpy())
    summed = [np.cumsum(x) for x in np.split(logs, ends)]
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pc.exp(pa.array(np.concatenate(summed))))


def with_survival(rows: DataFrame, by: list[str], order: str, hazard: str = "hazard") -> DataFrame:
    """Running product of one minus the hazard: a sum of logarithms, zero from the first certain event on.

    Where hazards are short decimals, products end in a five and the last bit decides how they round. Spark's own
    ``ln`` and ``exp`` differ there from the C library's, which SQL engines call; Arrow calls it too. A hazard of
    decimal type is taken from one exactly. A group is short, an age or a step a row, and goes as one list: what
    is partitioned by ``by`` is not exchanged again.
    """
    h, rest = F.col(hazard), [c for c in rows.columns if c not in by]
    left = F.when(h < 1, 1 - h).when(h >= 1, 0).otherwise(1).cast("double")
    lists = rows.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("_order"), left.alias("_left"), *rest))).alias("_rows"))
    products = lists.withColumn("survival", F.arrow_udf(_products, "array<double>")("_rows._left"))
    each = products.select(*by, F.explode(F.arrays_zip("_rows", "survival")).alias("_each"))
    return each.select(*[F.col(c) if c in by else F.col(f"_each._rows.`{c}`") for c in rows.columns], "_each.survival")


def curves(rows: DataFrame, score: Callable[[DataFrame], DataFrame], months: int = 60, key: str = "loan_id") -> DataFrame:
    """Projected survival for each row: features held, age rising month by month; ``score`` adds the hazard, double or decimal, as ``score``."""
    ahead = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(months))))
    aged = ahead.withColumn("loan_age_months", F.col("loan_age_months") + F.col("step") - 1)
    return with_survival(score(aged).select(key, "step", F.col("score").alias("hazard")), [key], "step").withColumn("hazard", F.col("hazard").cast("double"))


def naive(lives: DataFrame) -> DataFrame:
    """The baseline: one hazard for all ages, events over months at risk."""
    return lives.agg(F.sum("event").alias("events"), F.sum(F.col("age") - F.col("entry") + 1).alias("months")).select("events", "months", S.ratio(F.col("events").cast("double"), F.col("months").cast("double")).alias("hazard"))
