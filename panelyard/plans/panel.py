"""The panel's stages put together: raw records to features, labels and splits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyard.operators import clean, features, ingest, labels, rules
from panelyard.sources import testdata

#: Split boundaries for the test tables' years.
TEST_YEARS = {"train_end": dt.date(1997, 12, 31), "validation": (dt.date(1998, 1, 1), dt.date(1998, 12, 31)), "holdout": (dt.date(1999, 1, 1), dt.date(1999, 12, 31))}


class Panel:
    """Stages over one source of raw records; each is a lazy DataFrame."""

    def __init__(self, raw: DataFrame, with_feed: bool = True):
        self.raw = raw
        self.monthly = ingest.monthly(raw)
        self.static = ingest.static(raw)
        self.clean, self.quarantine = clean.clean_panel(self.monthly)
        self.feed = testdata.feed(self.monthly) if with_feed else None

    @property
    def joined(self) -> DataFrame:
        """The clean panel with the dimension and month_index; the dimension joins by key, broadcast only if Spark finds it small."""
        return ingest.with_month_index(self.clean.drop("source_file").join(self.static, "loan_id", "left"))

    @property
    def ruled(self) -> DataFrame:
        return rules.apply_rules(self.joined, self.feed)

    @property
    def features(self) -> DataFrame:
        return features.build(self.joined)

    def labelled(self, end: dt.date | None = None) -> DataFrame:
        return labels.add_targets(self.features, end)

    def split(self, end: dt.date | None = None, **bounds) -> DataFrame:
        end = end or labels.data_end(self.monthly)
        s = labels.Splits(end, **bounds)
        return labels.truncate_train(labels.assign_split(self.labelled(end), s), s)


def dense(spark: SparkSession, sf_dir: str) -> Panel:
    return Panel(testdata.raw_panel(spark, sf_dir))


def write_model_dataset(panel: Panel, path: str, **bounds) -> None:
    """The stages' outputs as Parquet: quarantine, rule scores, features and splits by partition."""
    panel.quarantine.write.mode("overwrite").parquet(f"{path}/quarantine")
    scored = panel.ruled.select("loan_id", "reporting_month", "dq_penalty", "dq_score", "n_hard_failures", "n_soft_failures", "exception_type", "reason")
    scored.write.mode("overwrite").parquet(f"{path}/dq_scores")
    out = panel.split(**bounds).withColumn("split", F.coalesce("split", F.lit("none")))
    out.write.mode("overwrite").partitionBy("split").parquet(f"{path}/model_dataset")
