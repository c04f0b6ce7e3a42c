import numpy as np
import pytest

from panelyard.llm import ann


def slow(rows, every=100, k=10):
    """Of every query (vec_id, vector) the k nearest rows but its own."""
    ok = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        ok.append((i, np.asarray(v, np.float32).astype(float) + 0.0))
    out = {}
    for at, (q, w) in enumerate(ok):
        if q % every == 0:
            near = sorted((float(np.sqrt(((w - v) ** 2).sum())), i) for j, (i, v) in enumerate(ok) if j != at and len(v) == len(w))
            out[q, tuple(w)] = near[:k]
    return out


def check(df, recall, **options):
    """Every query's true neighbours found, by recall; all rows found are true, ranked and exact."""
    want = slow([(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()], options.get("every", 100))
    got = {}
    for r in ann.search(df, **options).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    by_id = {}
    for (q, _), x in want.items():
        by_id.setdefault(q, []).append(x)
    hits = all_ = 0
    for q, lists in by_id.items():
        assert sorted(r for r, _, _ in got.get(q, [])) == sorted(i + 1 for x in lists for i in range(len(x)))
        if len(lists) == 1:
            assert [x[1:] for x in got.get(q, [])] == sorted(x[1:] for x in got.get(q, []))
        exact = [(pytest.approx(d, abs=1e-12), i) for x in lists for d, i in x]
        hits += sum((d, i) in exact for _, d, i in got.get(q, []))
        all_ += len(exact)
    assert set(got) <= set(by_id) and hits >= recall * all_


def test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    check(df, 0.95)
    check(df, 0.95, shard=300, block=4)


@pytest.mark.parametrize("spread", [0.4, 0.01])
def test_few_are_verified(spark, spread):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((50, 24))
    rows = [(i, (centres[i % 50] + spread * rng.standard_normal(24)).astype(np.float32).tolist()) for i in range(6000)]
    shard = ann.Shard(np.array([v for _, v in rows]))
    assert all(len(places) < 360 for places, _ in shard.search(np.array([v for _, v in rows[:20]]), 11))
    check(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 0.9)


def test_whatever_the_size(spark):
    """Recall comes from the lines, not from the number of vectors."""
    rng = np.random.default_rng(5)
    for n in (30, 300, 3000):
        rows = [(i, rng.standard_normal(16).astype(np.float32).tolist()) for i in range(n)]
        check(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 0.9, every=max(1, n // 60))


def test_far_vectors(spark):
    rows = [(i, [10.0 ** (i % 30), float(i)]) for i in range(200)] + [(1000, [1e200, 1.0]), (1001, [1e-300, 0.0])]
    check(spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("vec_id", "cast(embedding as array<float>) as embedding").filter("vec_id < 1000"), 0.9, every=10)
    assert ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).count() == 30


def test_shared_ids(spark):
    rows = [(100, [1.0, 0.0]), (100, [1.0, 0.0]), (100, [0.0, 3.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [4.0, 4.0])]
    got = [tuple(r) for r in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).select("vec_id", "score").collect()]
    assert sorted(got) == sorted(2 * [(1, 0.0)] + [(100, 0.0), (100, 10.0**0.5), (2, 5.0)] + 2 * [(1, 10.0**0.5)] + 2 * [(100, 10.0**0.5)] + [(2, 17.0**0.5)])


def test_odd(spark):
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [None, 1.0]), (200, [0.0, 0.0]), (300, [1.0, 2.0, 3.0]), (7, [-0.0, 1.0]), (8, [0.0, 1.0]), (None, [1.0, 1.0]), (9, []), (400, [])]
    rows += [(i, [5.0, 5.0]) for i in range(1000, 1060)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    check(df, 1.0)
    check(df, 1.0, shard=7, block=1)
    check(df.filter("vec_id > 1000"), 1.0, every=7)
    assert ann.search(df.filter("false")).count() == 0
