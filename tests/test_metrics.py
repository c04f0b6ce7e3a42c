import math

import numpy as np
import pytest

from panelyard.operators import metrics, ordered, profile


def scored(spark, rows):
    return spark.createDataFrame([(int(y), float(p)) for y, p in rows], "label int, score double")


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(3)
    y = rng.random(600) < 0.15
    p = np.round(np.clip(0.3 * y + rng.random(600) * 0.6, 0, 1), 2)
    return y.astype(int), p


def by_hand(y, p):
    cuts = sorted(set(p), reverse=True)
    pos, neg = y.sum(), (1 - y).sum()
    auc = sum((a > b) + (a == b) / 2 for a in p[y == 1] for b in p[y == 0]) / pos / neg
    ap, last, best, ks = 0, 0, (0, 0), 0
    for c in cuts:
        tp, fp = ((p >= c) & (y == 1)).sum(), ((p >= c) & (y == 0)).sum()
        prec, rec = tp / (tp + fp), tp / pos
        ap, last = ap + (rec - last) * prec, rec
        f1 = 2 * prec * rec / (prec + rec) if prec + rec else 0
        best = max(best, (f1, -c))
        below = ((p < c) & (y == 1)).sum() / pos - ((p < c) & (y == 0)).sum() / neg
        ks = max(ks, abs(below))
    return auc, ap, best, ks


def test_ranking(spark, sample):
    y, p = sample
    got = metrics.ranking(scored(spark, zip(y, p, strict=True))).first()
    auc, ap, best, ks = by_hand(y, p)
    assert got.roc_auc == pytest.approx(auc) and got.pr_auc == pytest.approx(ap) and got.ks == pytest.approx(ks) and got.f1 == pytest.approx(best[0]) and got.threshold == pytest.approx(-best[1])
    assert got.lift_top > 1


def test_ranking_without_ties_and_one_class(spark):
    got = metrics.ranking(scored(spark, [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1), (0, 0.05), (0, 0.04), (0, 0.03), (0, 0.02), (0, 0.015), (0, 0.01)])).first()
    assert got.roc_auc == pytest.approx(15 / 16) and got.lift_top == pytest.approx(5.0)
    one = metrics.ranking(scored(spark, [(0, 0.1), (0, 0.2)])).first()
    assert one.roc_auc is None and one.pr_auc is None and one.ks is None
    assert metrics.ranking(scored(spark, [])).first().roc_auc is None


def test_recall_at_precision(spark, sample):
    y, p = sample
    for r in metrics.recall_at_precision(scored(spark, zip(y, p, strict=True)), (0.2, 0.5, 0.999)).collect():
        ok = [((p >= c) & (y == 1)).sum() / y.sum() for c in set(p) if y[p >= c].mean() >= r.min_precision]
        assert r.recall == pytest.approx(max(ok, default=0.0)) and (ok or r.threshold == 1.0)


def test_errors_and_confusion(spark, sample):
    y, p = sample
    got = metrics.errors(scored(spark, zip(y, p, strict=True))).first()
    q = np.clip(p, 1e-7, 1 - 1e-7)
    assert got.brier == pytest.approx(((y - p) ** 2).mean()) and got.log_loss == pytest.approx(-(y * np.log(q) + (1 - y) * np.log(1 - q)).mean())
    c = metrics.confusion(scored(spark, zip(y, p, strict=True)), 0.4).first()
    assert (c.tp, c.fp, c.fn, c.tn) == tuple(int(((p >= 0.4) == h) @ (y == t)) if False else int((((p >= 0.4) == h) & (y == t)).sum()) for h, t in ((True, 1), (True, 0), (False, 1), (False, 0)))


def test_multiclass(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "y string, p string")
    got = {r.label: r for r in metrics.multiclass(df, "y", "p").collect()}
    assert got["a"].f1 == pytest.approx(0.5) and got["b"].f1 == pytest.approx(2 / 3) and got["c"].f1 == 0
    assert got["a"].accuracy == 0.5 and got["a"].macro_f1 == pytest.approx((0.5 + 2 / 3) / 3) and got["a"].weighted_f1 == pytest.approx((1.0 + 2 / 3) / 4)


def test_calibration(spark, sample):
    y, p = sample
    rows = metrics.calibration(scored(spark, zip(y, p, strict=True))).collect()
    edges = np.unique(np.quantile(p, np.linspace(0, 1, 11)))
    bins = np.digitize(p, edges[1:-1])
    assert {r.bin: r.n for r in rows} == {int(b): int((bins == b).sum()) for b in set(bins)}
    ece = sum(abs(p[bins == b].mean() - y[bins == b].mean()) * (bins == b).mean() for b in set(bins))
    assert sum(r.weight * r.gap for r in rows) == pytest.approx(ece)
    same = metrics.calibration(scored(spark, [(1, 0.5), (0, 0.5)])).collect()
    assert sum(r.n for r in same) == 2


def psi(e, a):
    edges = np.unique(np.quantile(e, np.linspace(0, 1, 11)))
    pe, pa = (np.clip(np.histogram(x, bins=edges)[0] / len(x), 1e-6, None) for x in (e, a))
    return ((pa - pe) * np.log(pa / pe)).sum()


def test_drift(spark):
    rng = np.random.default_rng(1)
    e, a = rng.normal(0, 1, 500), rng.normal(0.7, 1.3, 300)
    frame = lambda x: spark.createDataFrame([(float(v), 1.0, None) for v in x] + [(float("nan"), 1.0, None)], "x double, same double, none double")
    got = {r.feature: r for r in metrics.drift(frame(e), frame(a), ["x", "same", "none"]).collect()}
    assert got["x"].psi == pytest.approx(psi(e, a)) and got["x"].severity == "significant" and got["same"].psi == 0 and got["same"].severity == "stable" and "none" not in got


def test_quantiles_are_exact(spark):
    rng = np.random.default_rng(9)
    rows = [(g, float(v)) for g in "ab" for v in rng.integers(0, 40, 333 if g == "a" else 7)] + [("c", 4.0), ("d", None), ("a", float("nan"))]
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: r.quantiles for r in ordered.quantiles(spark.createDataFrame(rows, "g string, v double"), "v", probabilities, ["g"]).collect()}
    for g in "abc":
        assert got[g] == pytest.approx(np.quantile([v for k, v in rows if k == g and v is not None and not math.isnan(v)], probabilities).tolist())
    assert "d" not in got


def test_running(spark):
    rng = np.random.default_rng(2)
    values = rng.permutation(1000)
    df = spark.createDataFrame([(int(v) % 3, float(v), 1) for v in values], "k int, v double, n long")
    got = ordered.running(df, "v", ["n"], ["k"], parts=7).collect()
    assert all(r.cum_n == sum(1 for v in range(int(r.v) + 1) if v % 3 == r.k) for r in got) and len(got) == 1000
    assert sorted(r.cum_n for r in ordered.running(df, "v", ["n"]).collect()) == list(range(1, 1001))


def test_profile(spark):
    df = spark.createDataFrame([("x", ""), ("x", "aa"), ("y", None), ("", "b")], "a string, b string")
    got = {r.column: r for r in profile.columns(df, ["a", "b"]).collect()}
    assert got["a"].fill_rate == 0.75 and got["a"].examples == "x,y" and got["a"].n_distinct == 2 and got["b"].min_len == 1 and got["b"].max_len == 2 and got["b"].fill_rate == 0.5
    near = {r.column: r for r in profile.columns(df, ["a", "b"], approximate=True).collect()}
    assert near["a"].n_distinct == 2 and near["b"].fill_rate == 0.5
    assert [tuple(r) for r in profile.widths(spark.createDataFrame([("a|b",), ("c|d",), ("e",)], "value string")).collect()] == [(2, 2), (1, 1)]
    v = profile.cramers_v(spark.createDataFrame([("a", "x")] * 5 + [("b", "y")] * 5, "p string, q string"), "p", "q").first()
    assert v.cramers_v == pytest.approx(1)
