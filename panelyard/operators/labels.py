"""Forward-looking labels with completeness masks, and splits by calendar time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelyard.functions import scalar as S
from panelyard.functions.windows import by_entity, forward_any
from panelyard.plans import contract as C


def data_end(panel: DataFrame) -> dt.date:
    """The last reporting month, one value."""
    return panel.agg(F.max("reporting_month")).first()[0]


def add_targets(panel: DataFrame, end: dt.date | None = None) -> DataFrame:
    """The panel with its labels.  Horizons count rows ahead; completeness counts months to ``end`` (by default the panel's last month)."""
    end = end or data_end(panel)
    if end is None:
        end = dt.date(1900, 1, 1)
    left = F.lit(end.year * 12 + end.month) - S.month_number(F.col("reporting_month"))
    out = {}
    for name, (k, source) in C.HORIZONS.items():
        seen = F.coalesce(forward_any(F.col(source), k), F.lit(0))
        ended = F.coalesce(forward_any(F.col("is_terminated"), k), F.lit(0))
        out[name] = seen
        out[f"{name}_complete"] = ((left >= k) | (ended > 0) | (seen > 0)).cast("int")
    following = F.coalesce(F.lead("current_status").over(by_entity()), F.when(F.col("is_terminated"), F.col("current_status")))
    out["next_state"] = following
    out["next_state_complete"] = (following.isNotNull() & ((left >= 1) | F.col("is_terminated"))).cast("int")
    for name, source in (("next_12m_default_ex_forbearance", "default_flag_ex_forbearance"), ("next_12m_default_credit_event", "default_flag_credit_event")):
        out[name] = F.coalesce(forward_any(F.col(source), 12), F.lit(0))
    out["months_to_data_end"] = left
    return panel.select("*", *[v.alias(k) for k, v in out.items()])


class Splits:
    """Boundaries of the splits; the test window is the 12 months ending 12 months before the data's end and comes first."""

    def __init__(self, end: dt.date, train_end=dt.date(2020, 12, 31), validation=(dt.date(2021, 1, 1), dt.date(2021, 12, 31)),
                 holdout=(dt.date(2022, 1, 1), dt.date(2022, 12, 31)), gap: int = 12):
        n = end.year * 12 + end.month - 1 - gap
        self.test = dt.date((n - 11) // 12, (n - 11) % 12 + 1, 1), dt.date(n // 12, n % 12 + 1, 1)
        self.train_end, self.validation, self.holdout, self.gap = train_end, validation, holdout, gap


def assign_split(df: DataFrame, s: Splits) -> DataFrame:
    m = F.col("reporting_month")
    inside = lambda window: m.between(F.lit(window[0]), F.lit(window[1]))
    split = F.when(inside(s.test), "test").when(m <= F.lit(s.train_end), "train").when(inside(s.validation), "validation").when(inside(s.holdout), "holdout")
    return df.withColumn("split", split)


def truncate_train(df: DataFrame, s: Splits) -> DataFrame:
    """Drops training rows whose labels would look past the training period's end."""
    last = F.trunc(F.add_months(F.lit(s.train_end), -s.gap), "MM")
    return df.filter(~S.truth((F.col("split") == "train") & (F.col("reporting_month") > last)))
