"""Training, calibration, comparison and scoring of models on the labelled panel (MLlib)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelyard.functions import scalar as S
from panelyard.operators import metrics

SEED, CAP, LEAST_POSITIVES = 42, 150_000, 50
#: Trees of a forest and their depth.
TREES, DEPTH = 120, 14
ALGORITHMS = ("logistic_regression", "random_forest", "gradient_boosting")


def load_split(df: DataFrame, split: str, target: str, key: list[str], cap: int | None = None, seed: int = SEED) -> DataFrame:
    """A split's rows whose label is complete, at most ``cap`` by the order of a seeded hash."""
    rows = df.filter((F.col("split") == split) & (F.col(f"{target}_complete") == 1))
    return rows if cap is None else rows.orderBy(F.xxhash64(F.lit(seed), *key), *key).limit(cap)


def _cast(df: DataFrame, features: list[str], *more) -> DataFrame:
    return df.select(*more, *[F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))).alias(f) for f in features])


def _stages(features: list[str], scale: bool) -> list:
    filled = [f"{f}__filled" for f in features]
    out = [Imputer(inputCols=features, outputCols=filled, strategy="median"), VectorAssembler(inputCols=filled, outputCol="_x", handleInvalid="keep")]
    return [*out, StandardScaler(inputCol="_x", outputCol="features", withMean=True)] if scale else [out[0], VectorAssembler(inputCols=filled, outputCol="features", handleInvalid="keep")]


def _classifier(algorithm: str, trees: int, multi: bool = False):
    common = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight"}
    if algorithm == "logistic_regression":
        return LogisticRegression(**common, maxIter=100, regParam=1e-4)
    if algorithm == "random_forest":
        return RandomForestClassifier(**common, numTrees=trees, maxDepth=DEPTH, seed=SEED)
    if multi:
        raise ValueError("boosting is for two classes")
    return GBTClassifier(**common, maxIter=max(5, trees // 4), maxDepth=5, seed=SEED)


@dataclass
class Bundle:
    """A fitted model with its calibrator and lineage."""

    model: PipelineModel
    calibrator: object | None
    target: str
    algorithm: str
    features: list[str]
    metrics: dict = field(default_factory=dict)

    def raw(self, df: DataFrame, *keep) -> DataFrame:
        given = _cast(df, self.features, F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
        return self.model.transform(given).select("_row", vector_to_array("probability")[1].alias("_p"))

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        """``df`` with the calibrated probability."""
        out = self.raw(df)
        if self.calibrator is not None:
            out = self.calibrator.transform(out).withColumn("_p", S.clip(F.col("_c"), 0, 1))
        return out.select("_row.*", F.col("_p").alias(name))


def train(train_df: DataFrame, valid_df: DataFrame, target: str, features: list[str], algorithm: str = "logistic_regression", trees: int = TREES, calibrate: str = "isotonic") -> Bundle:
    """Fit on the training rows, classes weighted evenly, and calibrate on the validation rows."""
    # The stages fit one after the other, each over all rows: what they read is kept meanwhile.
    given = _cast(train_df, features, F.col(target).cast("double").alias("label")).persist()
    try:
        counts = {r.label: r.n for r in given.groupBy("label").agg(F.count("*").alias("n")).collect()}
        n = sum(counts.values())
        weight = F.when(F.col("label") == 1, n / (2 * max(1, counts.get(1.0, 0)))).otherwise(n / (2 * max(1, counts.get(0.0, 0))))
        rows = given.withColumn("weight", weight)
        model = Pipeline(stages=[*_stages(features, algorithm == "logistic_regression"), _classifier(algorithm, trees)]).fit(rows)
    finally:
        given.unpersist()
    bundle = Bundle(model, None, target, algorithm, list(features))
    held = bundle.raw(valid_df).select("_p", F.col(f"_row.{target}").cast("double").alias("label"))
    if calibrate == "isotonic":
        bundle.calibrator = IsotonicRegression(featuresCol="_p", labelCol="label", predictionCol="_c").fit(held)
    elif calibrate == "platt":
        fitted = Pipeline(stages=[VectorAssembler(inputCols=["_p"], outputCol="_pv"), LogisticRegression(featuresCol="_pv", labelCol="label", probabilityCol="_cv", rawPredictionCol="_cr", predictionCol="_cp")]).fit(held)
        bundle.calibrator = _Platt(fitted)
    return bundle


class _Platt:
    def __init__(self, fitted):
        self.fitted = fitted

    def transform(self, df):
        return self.fitted.transform(df).withColumn("_c", vector_to_array("_cv")[1]).drop("_pv", "_cv", "_cr", "_cp")


def evaluate(bundle: Bundle, df: DataFrame) -> DataFrame:
    scored = bundle.score(df).select(F.col(bundle.target).alias("label"), "score").cache()
    try:
        one = {**metrics.errors(scored).first().asDict(), **metrics.ranking(scored).first().asDict()}
    finally:
        scored.unpersist()
    return one


def compare(df: DataFrame, target: str, features: list[str], key: list[str], algorithms=ALGORITHMS, cap: int = CAP, trees: int = TREES, registry=None) -> list[dict]:
    """Every algorithm trained, calibrated and tested; best by test PR-AUC first, with uplift over the logistic baseline.

    Targets with fewer than LEAST_POSITIVES positive training rows are skipped.
    """
    splits = {s: load_split(df, s, target, key, cap).cache() for s in ("train", "validation", "test")}
    try:
        if splits["train"].filter(F.col(target) == 1).count() < LEAST_POSITIVES:
            return []
        out = []
        for algorithm in algorithms:
            bundle = train(splits["train"], splits["validation"], target, features, algorithm, trees)
            bundle.metrics = {s: evaluate(bundle, splits[s]) for s in ("validation", "test")}
            if registry is not None:
                registry.register(f"{target}_model", bundle)
            out.append({"target": target, "algorithm": algorithm, **bundle.metrics["test"]})
    finally:
        for s in splits.values():
            s.unpersist()
    base = next((r["pr_auc"] for r in out if r["algorithm"] == "logistic_regression"), None)
    for r in out:
        r["uplift"] = None if base is None or r["pr_auc"] is None else r["pr_auc"] - base
    return sorted(out, key=lambda r: -(r["pr_auc"] or 0))


@dataclass
class StateBundle:
    model: PipelineModel
    labels: list[str]
    features: list[str]

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with predicted_state, its probability as confidence, and the probabilities of all states."""
        given = _cast(df, self.features, F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
        out = self.model.transform(given)
        names = F.array(*[F.lit(x) for x in self.labels])
        return out.select("_row.*", F.element_at(names, F.col("prediction").cast("int") + 1).alias("predicted_state"), F.array_max(vector_to_array("probability")).alias("confidence"),
                          F.map_from_arrays(names, vector_to_array("probability")).alias("state_probabilities"))


def train_states(df: DataFrame, features: list[str], algorithm: str = "random_forest", target: str = "next_state", trees: int = TREES) -> StateBundle:
    """A model of the next state over all classes, rows weighted by inverse class frequency."""
    rows = df.filter((F.col(f"{target}_complete") == 1) & F.col(target).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(target).count().collect()}
    n = sum(counts.values())
    weight = F.lit(1.0)
    for state, m in counts.items():
        weight = F.when(F.col("_y") == state, n / (len(counts) * m)).otherwise(weight)
    given = _cast(rows, features, F.col(target).alias("_y")).withColumn("weight", weight)
    indexer: StringIndexerModel = StringIndexer(inputCol="_y", outputCol="label", stringOrderType="alphabetAsc").fit(given)
    model = Pipeline(stages=[*_stages(features, algorithm == "logistic_regression"), _classifier(algorithm, trees, multi=True)]).fit(indexer.transform(given))
    return StateBundle(model, list(indexer.labels), list(features))


def best_states(train_df: DataFrame, valid_df: DataFrame, features: list[str], algorithms=("logistic_regression", "random_forest"), target: str = "next_state", trees: int = TREES) -> tuple[StateBundle, dict[str, float]]:
    """The model with the best macro F1 on the validation rows, and every algorithm's."""
    held = valid_df.filter((F.col(f"{target}_complete") == 1) & F.col(target).isNotNull())
    found = {}
    for algorithm in algorithms:
        bundle = train_states(train_df, features, algorithm, target, trees)
        row = metrics.multiclass(bundle.score(held), target, "predicted_state").select("macro_f1").first()
        found[algorithm] = (row.macro_f1 if row else 0.0, bundle)
    best = max(found, key=lambda a: found[a][0])
    return found[best][1], {a: f for a, (f, _) in found.items()}


def spread(bundles: list[Bundle], df: DataFrame, key: list[str]) -> DataFrame:
    """(key, mean, low, high): the models' mean probability with a band of two standard deviations, held to 0 and 1."""
    each = [f"_s{i}" for i in range(len(bundles))]
    for name, bundle in zip(each, bundles, strict=True):
        df = bundle.score(df, name)
    n = len(each)
    mean = sum((F.col(c) for c in each), F.lit(0.0)) / n
    apart = F.sqrt(sum(((F.col(c) - F.col("mean")) ** 2 for c in each), F.lit(0.0)) / n)
    rows = df.select(*key, *each, mean.alias("mean")).withColumn("apart", apart)
    return rows.select(*key, "mean", S.clip(F.col("mean") - 2 * F.col("apart"), 0, 1).alias("low"), S.clip(F.col("mean") + 2 * F.col("apart"), 0, 1).alias("high"))


def importances(bundle: Bundle) -> list[tuple[str, float]]:
    """Features by importance: a tree model's own, or absolute standardised coefficients."""
    last = bundle.model.stages[-1]
    values = last.featureImportances.toArray() if hasattr(last, "featureImportances") else abs(last.coefficients.toArray())
    return sorted(zip(bundle.features, map(float, values), strict=True), key=lambda x: (-x[1], x[0]))
