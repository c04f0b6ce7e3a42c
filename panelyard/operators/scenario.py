"""Scenario stress: shifted inputs, scored again, times the scenario's multiplier."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyard.functions import scalar as S
from panelyard.plans import contract as C

#: Which multiplier a target takes.
MULTIPLIERS = {"delinquency": "delinquency_multiplier", "default": "default_multiplier", "prepayment": "prepayment_multiplier"}


def scenarios(spark: SparkSession, overrides: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """The parameter table, three rows, with single values overridden by scenario."""
    rows = []
    for r in C.SCENARIOS:
        named = dict(zip(C.SCENARIO_COLUMNS, r, strict=True)) | (overrides or {}).get(r[0], {})
        rows.append(tuple(v if k == "scenario_name" else float(v) for k, v in named.items()))
    return spark.createDataFrame(rows, ", ".join(f"{c} {'string' if c == 'scenario_name' else 'double'}" for c in C.SCENARIO_COLUMNS))


def multiplier(target: str) -> str:
    return next((m for word, m in MULTIPLIERS.items() if word in target), "default_multiplier")


def stress(portfolio: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Each row under each scenario: rate in percent plus basis points over 10000, days past due plus 30 for each stressed month.

    The parameter table is a handful of rows, broadcast by its fixed size.
    """
    both = portfolio.crossJoin(F.broadcast(scenarios))
    shifts = {"current_interest_rate": F.col("rate_shift_bps") / 10000.0, "days_past_due": F.col("dpd_stress_months") * 30.0}
    return both.select(*[(F.col(c) + shifts[c]).alias(c) if c in shifts else F.col(f"`{c}`") for c in both.columns])


def simulate(portfolio: DataFrame, scenarios: DataFrame, target: str, score: Callable[[DataFrame], DataFrame], by: list[str] = ()) -> DataFrame:
    """Portfolio mean of the stressed probability by scenario, over all rows and, with ``by``, by segment too.

    ``score`` adds the column ``score`` to a frame.
    """
    scored = score(stress(portfolio, scenarios))
    p = S.clip(F.col("score") * F.col(multiplier(target)), 0, 1)
    rows = scored.select("scenario_name", *by, p.alias("p"))
    if not by:
        return rows.groupBy("scenario_name").agg(F.count("*").alias("n"), F.avg("p").alias("portfolio_rate"))
    sets = [["scenario_name"], *[["scenario_name", b] for b in by]]
    return rows.groupingSets(sets, "scenario_name", *by).agg(F.count("*").alias("n"), F.avg("p").alias("portfolio_rate"), F.grouping_id().alias("level"))


def compare(simulated: DataFrame) -> DataFrame:
    """Scenarios side by side, and their distance from the base."""
    names = [r[0] for r in C.SCENARIOS]
    one = simulated.groupBy().pivot("scenario_name", names).agg(F.first("portfolio_rate"))
    return one.select(*names, *[(F.col(n) - F.col("base")).alias(f"{n}_delta") for n in names[1:]])
