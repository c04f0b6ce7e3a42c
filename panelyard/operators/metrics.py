"""Evaluation of scores against labels, calibration and drift, as table algebra.

Frames have an integer ``label`` (0 or 1) and a double ``score``.  Rows first collapse to
distinct scores, so ties are exact; the collapsed table is settled once and sums along the
scores run in two phases over it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelyard.functions import scalar as S
from panelyard.operators.ordered import long, quantiles, running
from panelyard.plans import contract as C
from panelyard.sources.tables import settled


def curve(df: DataFrame) -> DataFrame:
    """(score, pos, neg, tp, fp, all_pos, all_neg) by distinct score; tp and fp count rows at or above it."""
    each = df.groupBy(F.col("score").cast("double").alias("score")).agg(F.sum(F.col("label").cast("long")).alias("pos"), F.sum(1 - F.col("label").cast("long")).alias("neg"))
    each = settled(each)
    up = running(each, "score", ["pos", "neg"])
    p, n = (F.coalesce(each.agg(F.sum(c)).scalar(), F.lit(0)).cast("long") for c in ("pos", "neg"))
    return up.withColumn("all_pos", p).withColumn("all_neg", n).select(
        "score", "pos", "neg", (F.col("all_pos") - F.col("cum_pos") + F.col("pos")).alias("tp"), (F.col("all_neg") - F.col("cum_neg") + F.col("neg")).alias("fp"), "all_pos", "all_neg")


def _d(c: str) -> Column:
    return F.col(c).cast("double")


def _rates() -> tuple[Column, Column, Column]:
    precision, recall = _d("tp") / (_d("tp") + _d("fp")), S.ratio(_d("tp"), _d("all_pos"))
    return precision, recall, S.ratio(2.0 * precision * recall, precision + recall)


def ranking(df: DataFrame, top: float = 0.10) -> DataFrame:
    """One row: roc_auc, pr_auc, ks, lift and the best F1 with its threshold; null where a class is missing."""
    precision, recall, f1 = _rates()
    two = (F.col("all_pos") > 0) & (F.col("all_neg") > 0)
    below = _d("all_neg") - _d("fp")
    rows = curve(df).withColumn("f1", F.coalesce(f1, F.lit(0.0)))
    k = F.greatest(F.lit(1).cast("long"), F.floor((F.col("all_pos") + F.col("all_neg")) * F.lit(top)))
    above = F.col("tp") + F.col("fp") - F.col("pos") - F.col("neg")
    taken = F.greatest(F.lit(0).cast("long"), F.least(F.col("pos") + F.col("neg"), k - above)).cast("double")
    got = taken * _d("pos") / (_d("pos") + _d("neg"))
    return rows.agg(
        F.sum(F.when(two, _d("pos") * (below + _d("neg") / 2) / (_d("all_pos") * _d("all_neg")))).alias("roc_auc"), F.sum(F.when(two, S.ratio(_d("pos"), _d("all_pos")) * precision)).alias("pr_auc"),
        F.max(F.when(two, F.abs((_d("tp") - _d("pos")) / _d("all_pos") - (_d("fp") - _d("neg")) / _d("all_neg")))).alias("ks"),
        F.sum(F.when(two, got / k / (_d("all_pos") / (_d("all_pos") + _d("all_neg"))))).alias("lift_top"),
        F.max(F.when(two, F.col("f1"))).alias("f1"), F.max_by(F.when(two, F.col("score")), F.struct("f1", -F.col("score"))).alias("threshold"))


def recall_at_precision(df: DataFrame, floors: tuple[float, ...] = (0.3, 0.5, 0.7)) -> DataFrame:
    """For each floor the highest recall with at least that precision, and its threshold; recall 0 at threshold 1 where there is none."""
    precision, recall, _ = _rates()
    rows = curve(df).withColumn("precision", precision).withColumn("recall", recall)
    picks = [F.max_by(F.struct("recall", "precision", F.col("score").alias("threshold")), F.when(F.col("precision") >= f, F.struct("recall", -F.col("score")))) for f in floors]
    one = rows.agg(F.max("precision").alias("top"), *[p.alias(f"p{i}") for i, p in enumerate(picks)])
    out = F.array(*[F.struct(F.lit(float(f)).alias("min_precision"), F.col(f"p{i}").alias("p")) for i, f in enumerate(floors)])
    return one.select("top", F.inline(out)).select(
        "min_precision", F.coalesce("p.recall", F.lit(0.0)).alias("recall"), F.coalesce("p.precision", "top").alias("precision"), F.coalesce("p.threshold", F.lit(1.0)).alias("threshold"))


def errors(df: DataFrame) -> DataFrame:
    """One row: n, positives, base rate, Brier score and skill, log loss (scores held off 0 and 1)."""
    y, p = _d("label"), F.col("score")
    held = S.clip(p, 1e-7, 1 - 1e-7)
    one = df.agg(
        F.count("*").alias("n"), F.sum(F.col("label").cast("long")).alias("n_positive"), F.avg(y).alias("base_rate"), F.avg((y - p) * (y - p)).alias("brier"),
        F.avg(-(y * F.log(held) + (1 - y) * F.log(1 - held))).alias("log_loss"))
    return one.withColumn("brier_skill", 1 - S.ratio(F.col("brier"), F.col("base_rate") * (1 - F.col("base_rate"))))


def confusion(df: DataFrame, threshold: float) -> DataFrame:
    hit, y = F.col("score") >= threshold, F.col("label") == 1
    one = df.agg(F.count_if(hit & y).alias("tp"), F.count_if(hit & ~y).alias("fp"), F.count_if(~hit & y).alias("fn"), F.count_if(~hit & ~y).alias("tn"))
    return one.select(
        "*", F.coalesce(S.ratio(_d("tp"), _d("tp") + _d("fp")), F.lit(0.0)).alias("precision"), F.coalesce(S.ratio(_d("tp"), _d("tp") + _d("fn")), F.lit(0.0)).alias("recall"),
        S.ratio(_d("tp") + _d("tn"), _d("tp") + _d("fp") + _d("fn") + _d("tn")).alias("accuracy"))


def multiclass(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Per class: support, true and false positives, F1; with overall accuracy, macro and weighted F1 on every row."""
    pairs = df.groupBy(F.col(actual).alias("a"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))
    long_ = pairs.select(F.col("a").alias("label"), F.col("n").alias("support"), F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(0).alias("tp"), F.lit(0).cast("long").alias("predicted")).union(
        pairs.select("p", F.lit(0).cast("long"), F.lit(0).cast("long"), "n"))
    per = long_.groupBy("label").agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"), F.sum("predicted").alias("n_predicted"))
    per = per.withColumn("f1", F.coalesce(S.ratio(2.0 * _d("tp"), _d("support") + _d("n_predicted")), F.lit(0.0)))
    # As many rows as classes.
    whole = per.agg(F.sum("tp").alias("t"), F.sum("support").alias("s"), F.avg("f1").alias("m"), F.sum(F.col("f1") * F.col("support")).alias("w")).first()
    s = whole.s or 1
    return per.select("label", "support", "tp", "n_predicted", "f1", F.lit((whole.t or 0) / s).alias("accuracy"), F.lit(whole.m).alias("macro_f1"), F.lit((whole.w or 0.0) / s).alias("weighted_f1"))


def one_vs_rest(df: DataFrame, actual: str, probabilities: str) -> DataFrame:
    """(label, n_positive, auc) for every class of ``probabilities`` (a map from class to probability), ties counted half; null where a side is missing."""
    rows = df.filter(F.col(actual).isNotNull()).select(F.col(actual).alias("a"), F.explode(probabilities).alias("label", "score"))
    each = settled(rows.groupBy("label", F.col("score").cast("double").alias("score")).agg(F.count_if(F.col("a") == F.col("label")).alias("pos"), F.count_if(F.col("a") != F.col("label")).alias("neg")))
    up = running(each, "score", ["pos", "neg"], ["label"])
    whole = each.groupBy("label").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    share = _d("pos") * (_d("cum_neg") - _d("neg") / 2)
    return up.join(whole, "label").groupBy("label").agg(F.max("p").alias("n_positive"), (F.sum(share) / F.nullif(F.max(_d("p") * _d("n")), F.lit(0.0))).alias("auc"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def calibration(df: DataFrame, bins: int = 10) -> DataFrame:
    """(bin, n, mean_predicted, observed_rate, weight, gap): quantile bins, right-open; the sum of weight times gap is the ECE."""
    found = quantiles(df, "score", [i / bins for i in range(bins + 1)]).select(F.array_sort(F.array_distinct("quantiles")))
    rows = df.select(F.col("score"), _d("label").alias("label")).withColumn("_edges", found.scalar())
    even = F.transform(F.sequence(F.lit(0), F.lit(bins)), lambda i: F.greatest(F.element_at("_edges", -1), F.lit(1e-6)) * i / bins)
    edges = F.when(F.size("_edges") < 3, even).otherwise(F.col("_edges"))
    inner = F.slice(edges, 2, F.size(edges) - 2)
    at = F.size(F.filter(inner, lambda e: e <= F.col("score")))
    by = rows.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.avg("score").alias("mean_predicted"), F.avg("label").alias("observed_rate"))
    weight = F.col("n") / df.agg(F.count("*")).scalar().cast("double")
    return by.select("*", weight.alias("weight"), F.abs(F.col("mean_predicted") - F.col("observed_rate")).alias("gap"))


def drift(expected: DataFrame, actual: DataFrame, features: list[str], bins: int = 10, eps: float = 1e-6) -> DataFrame:
    """(feature, psi, severity, expected_mean, actual_mean): population stability index over the expected's quantile bins.

    The last bin is closed; values outside all bins count in the total alone.  Fewer than ten values on a side give null, fewer than two bins 0.
    """
    base, other = long(expected, features), long(actual, features)
    cuts = quantiles(base, "value", [i / bins for i in range(bins + 1)], ["feature"]).select("feature", F.array_sort(F.array_distinct("quantiles")).alias("edges"))

    def counted(rows: DataFrame, side: str) -> DataFrame:
        top = F.size("edges")
        at = F.size(F.filter("edges", lambda e: e <= F.col("value")))
        at = F.when(F.col("value") == F.element_at("edges", -1), top - 1).when((at >= 1) & (at < top), at).otherwise(0)
        held = rows.filter(F.col("value").isNotNull() & ~F.isnan("value")).join(cuts, "feature")
        return held.groupBy("feature", at.alias("bin")).agg(F.count("*").alias(side), F.sum("value").alias(f"{side}_sum"))

    both = counted(base, "e").join(counted(other, "a"), ["feature", "bin"], "full").select("feature", "bin", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("e", "a")], *[F.coalesce(f"{c}_sum", F.lit(0.0)).alias(f"{c}_sum") for c in ("e", "a")])
    listed = both.groupBy("feature").agg(F.collect_list(F.struct("bin", "e", "a")).alias("rows"), F.sum("e").alias("ne"), F.sum("a").alias("na"), F.sum("e_sum").alias("se"), F.sum("a_sum").alias("sa"))
    rows = cuts.join(listed, "feature", "left")

    def term(i):
        mine = F.filter("rows", lambda r: r["bin"] == i)
        share = lambda c, n: F.greatest(F.coalesce(F.get(mine, F.lit(0))[c], F.lit(0)).cast("double") / F.col(n), F.lit(eps))
        return (share("a", "na") - share("e", "ne")) * F.log(share("a", "na") / share("e", "ne"))

    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.size("edges") - 1), term), F.lit(0.0), lambda s, x: s + x)
    psi = F.when((F.coalesce("ne", F.lit(0)) < 10) | (F.coalesce("na", F.lit(0)) < 10), None).when(F.size("edges") < 3, 0.0).otherwise(total)
    return rows.withColumn("psi", psi).select("feature", "psi", S.level(F.col("psi"), C.PSI_LEVELS).alias("severity"), S.ratio(F.col("se"), _d("ne")).alias("expected_mean"), S.ratio(F.col("sa"), _d("na")).alias("actual_mean"))


def slices(df: DataFrame, segment: str, threshold: float) -> DataFrame:
    """False positives and negatives by segment."""
    hit, y = F.col("score") >= threshold, F.col("label") == 1
    by = df.groupBy(segment).agg(F.count("*").alias("n"), F.count_if(hit & ~y).alias("fp"), F.count_if(~hit & y).alias("fn"), F.count_if(y).alias("n_positive"))
    return by.select("*", S.ratio(_d("fp"), _d("n") - _d("n_positive")).alias("fp_rate"), S.ratio(_d("fn"), _d("n_positive")).alias("fn_rate"))
