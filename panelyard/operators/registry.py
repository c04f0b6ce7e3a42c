"""A model registry on the storage that executors share: events that are never changed, and what follows from them.

Under ``root`` lie the models, a folder for each version, and ``events``, one JSON record for each
thing that happened.  Nothing is ever rewritten: a version's stage, and who is in production, are queries
over the events, so a reader sees all of an event or none of it.  One writer at a time is assumed.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelyard.operators.models import Bundle
from panelyard.plans import contract as C

STAGING, PRODUCTION, ARCHIVED = "staging", "production", "archived"
EVENT = "seq long, at timestamp, model string, version int, stage string, score double, about string"


@dataclass(frozen=True)
class Ruling:
    """Whether a version took the stage it was put up for, which one had it, and what decided."""

    granted: bool
    holder: int | None
    ground: str


class Registry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._loaded: dict[tuple[str, int], Bundle] = {}

    def _there(self, name: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def events(self) -> DataFrame:
        if not self._there("events"):
            return self.spark.createDataFrame([], EVENT)
        return self.spark.read.schema(EVENT).json(f"{self.root}/events")

    def _happened(self, model: str, version: int, stage: str, score: float | None, about: str | None = None) -> None:
        seq = (self.events().agg(F.max("seq")).first()[0] or 0) + 1
        row = (seq, dt.datetime.now(dt.UTC).replace(tzinfo=None), model, version, stage, score, about)
        self.spark.createDataFrame([row], EVENT).coalesce(1).write.mode("append").json(f"{self.root}/events")

    def standing(self) -> DataFrame:
        """(model, version, stage, score, about): every version where its last event left it; who lost production to another is archived."""
        last = self.events().groupBy("model", "version").agg(
            F.max_by("stage", "seq").alias("stage"), F.max("seq").alias("seq"), F.max("score").alias("score"), F.max("about").alias("about"))
        later = F.max("seq").over(Window.partitionBy("model", "stage"))
        lost = (F.col("stage") == PRODUCTION) & (F.col("seq") < later)
        return last.select("model", "version", F.when(lost, ARCHIVED).otherwise(F.col("stage")).alias("stage"), "seq", "score", "about")

    def register(self, model: str, bundle: Bundle) -> int:
        """Save the model with its lineage; its version, now the one in staging."""
        version = (self.events().filter(F.col("model") == model).agg(F.max("version")).first()[0] or 0) + 1
        at = f"{self.root}/models/{model}/{version}"
        bundle.model.write().overwrite().save(f"{at}/model")
        if isinstance(bundle.calibrator, IsotonicRegressionModel):
            bundle.calibrator.write().overwrite().save(f"{at}/calibrator")
        about = {
            "target": bundle.target, "algorithm": bundle.algorithm, "features": bundle.features, "metrics": bundle.metrics, "calibrated": isinstance(bundle.calibrator, IsotonicRegressionModel),
            "versions": [C.CONFIG_VERSION, C.FEATURE_VERSION, C.SCHEMA_VERSION]}
        known = [bundle.metrics.get(s, {}).get("pr_auc") for s in ("test", "validation")]
        self._happened(model, version, STAGING, next((x for x in known if x is not None), None), json.dumps(about))
        return version

    def find(self, model: str, wanted: str | int = PRODUCTION) -> int:
        """The version that holds a stage, the newest where none does; or the version itself, if it exists."""
        rows = self.standing().filter(F.col("model") == model).collect()
        if not rows:
            raise KeyError(f"no model {model!r}")
        if isinstance(wanted, int):
            if wanted not in {r.version for r in rows}:
                raise KeyError(f"no version {wanted} of {model!r}")
            return wanted
        held = [(r.seq, r.version) for r in rows if r.stage == wanted]
        return max(held)[1] if held else max(r.version for r in rows)

    def put_up(self, model: str, version: int, stage: str = PRODUCTION, gain: float | None = 0.0) -> Ruling:
        """Move a version to a stage.  Into production only if its score is ``gain`` above the holder's; None asks for nothing."""
        self.find(model, version)
        rows = {r.version: r for r in self.standing().filter(F.col("model") == model).collect()}
        holder = next((v for v, r in rows.items() if r.stage == PRODUCTION and v != version), None) if stage == PRODUCTION else None
        mine, theirs = rows[version].score, rows[holder].score if holder else None
        if gain is not None and mine is not None and theirs is not None and mine - theirs < gain:
            return Ruling(False, holder, f"a PR-AUC of {mine:.4f} is not {gain} above {theirs:.4f}")
        self._happened(model, version, stage, mine)
        return Ruling(True, holder, "no holder" if holder is None else "above the holder" if gain is not None else "no gain asked for")

    def load(self, model: str, wanted: str | int = PRODUCTION) -> Bundle:
        """The model, read once."""
        version = self.find(model, wanted)
        if (model, version) not in self._loaded:
            about = json.loads(self.standing().filter((F.col("model") == model) & (F.col("version") == version)).first().about)
            at = f"{self.root}/models/{model}/{version}"
            calibrator = IsotonicRegressionModel.load(f"{at}/calibrator") if about["calibrated"] else None
            self._loaded[model, version] = Bundle(PipelineModel.load(f"{at}/model"), calibrator, about["target"], about["algorithm"], about["features"], about["metrics"])
        return self._loaded[model, version]
