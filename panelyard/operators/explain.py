"""Local explanations: exact for linear models, by paths for trees; never random."""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelyard.operators.models import Bundle


def _linear(bundle: Bundle) -> dict[str, tuple[float, float, float]]:
    """Feature: coefficient on the raw scale, training mean, value for missing ones."""
    imputer, scaler, last = bundle.model.stages[0], bundle.model.stages[2], bundle.model.stages[-1]
    filled = imputer.surrogateDF.first().asDict()
    beta, std, mean = last.coefficients.toArray(), scaler.std.toArray(), scaler.mean.toArray()
    return {f: (float(b / s) if s else 0.0, float(m), float(filled[f])) for f, b, s, m in zip(bundle.features, beta, std, mean, strict=True)}


def _nodes(tree) -> np.ndarray:
    """(feature, cut, left, right, value) rows of a fitted tree, root first."""
    rows: list[list[float]] = []

    def walk(node):
        at = len(rows)
        rows.append([-1, 0, 0, 0, 0])
        if node.subtreeDepth() == 0:
            stats = np.array(node.impurityStats().stats())
            rows[at][4] = stats[1] / stats.sum() if len(stats) == 2 and stats.sum() else node.prediction()
            return at, max(stats.sum(), 1e-12)
        split = node.split()
        rows[at][:2] = [split.featureIndex(), split.threshold()]
        rows[at][2], wl = walk(node.leftChild())
        rows[at][3], wr = walk(node.rightChild())
        rows[at][4] = (rows[rows[at][2]][4] * wl + rows[rows[at][3]][4] * wr) / (wl + wr)
        return at, wl + wr

    walk(tree._java_obj.rootNode() if hasattr(tree, "_java_obj") else tree.rootNode())
    return np.array(rows, float)


def _paths(batches, trees, weights, width):
    """Along each row's path every split's change of the mean value goes to the split's feature."""
    for batch in batches:
        x = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(width)], 1)
        out = np.zeros_like(x)
        n = np.arange(len(x))
        for tree, weight in zip(trees, weights, strict=True):
            at = np.zeros(len(x), int)
            while True:
                f = tree[at, 0].astype(int)
                inner = f >= 0
                if not inner.any():
                    break
                to = np.where(inner, np.where(x[n, np.maximum(f, 0)] <= tree[at, 1], tree[at, 2], tree[at, 3]).astype(int), at)
                np.add.at(out, (n[inner], f[inner]), weight * (tree[to, 4] - tree[at, 4])[inner])
                at = to
        yield pa.RecordBatch.from_arrays([batch.column(width), pa.array(list(out), pa.list_(pa.float64()))], ["row", "parts"])


def explain(df: DataFrame, bundle: Bundle, key: list[str], k: int = 5) -> DataFrame:
    """(key, drivers): the ``k`` features with the largest contributions, with sign; they sum, over all features, to
    the distance from the mean prediction (log-odds for linear and boosted models, probability for forests)."""
    features = bundle.features
    if bundle.algorithm == "logistic_regression":
        parts = [F.lit(b) * (F.coalesce(F.col(f).cast("double"), F.lit(v)) - F.lit(m)) for f, (b, m, v) in _linear(bundle).items()]
        rows = df.select(*key, F.array(*parts).alias("parts"))
    else:
        filled = bundle.model.stages[0].surrogateDF.first().asDict()
        last = bundle.model.stages[-1]
        trees = [_nodes(t) for t in last.trees]
        weights = [w / (len(trees) if bundle.algorithm == "random_forest" else 1) for w in last.treeWeights]
        row = F.struct(*key).alias("row")
        kind = df.select(row).schema["row"].dataType.simpleString()
        given = df.select(*[F.coalesce(F.col(f).cast("double"), F.lit(float(filled[f]))).alias(f) for f in features], row)
        rows = given.mapInArrow(partial(_paths, trees=trees, weights=weights, width=len(features)), f"row {kind}, parts array<double>").select("row.*", "parts")
    names = F.array(*[F.lit(f) for f in features])
    each = F.zip_with(names, "parts", lambda n, p: F.struct((-F.abs(p)).alias("o"), n.alias("feature"), p.alias("contribution")))
    top = F.slice(F.array_sort(each), 1, k)
    return rows.select(*key, F.transform(top, lambda x: F.struct(x["feature"].alias("feature"), x["contribution"].alias("contribution"), F.when(x["contribution"] > 0, "increases").otherwise("decreases").alias("effect"))).alias("drivers"))
