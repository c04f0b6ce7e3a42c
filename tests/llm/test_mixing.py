from collections import Counter

import numpy as np
import pytest

from panelyard.llm import mixing


def slow_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, done = sum(sizes.values()), {}
    while True:
        left = total - sum(done.values())
        open_w = sum(w[s] for s in names if s not in done)
        share = {s: left * w[s] / open_w for s in names if s not in done}
        over = [s for s in share if share[s] > most * sizes[s]]
        if not over:
            return done | share
        done |= {s: most * sizes[s] for s in over}


def check(docs, slack=0.5):
    got = [r.asDict() for r in mixing.mix(docs, keep=True).collect()]
    rows = docs.select("doc_id", "source", "text", mixing.row_key(docs)).collect()
    by_key = {(r.doc_id, r.row_key): r for r in rows}
    for r in got:
        r["row"] = by_key[r["doc_id"], r["row_key"]].asDict()
    assert len(got) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").encode().split())
    want = slow_targets(sizes)
    taken, largest = {}, {}
    for r in got:
        s = r["row"]["source"]
        assert r["size"] == len((r["row"]["text"] or "").encode().split()) and r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[s] = taken.get(s, 0) + r["taken"]
        if r["size"]:
            largest[s] = max(largest.get(s, 0), r["size"])
    for s, t in taken.items():
        assert abs(t - want[s]) <= max(1, slack * largest.get(s, 0))
    texts = Counter()
    for r in got:
        texts[r["doc_id"], r["row"]["text"]] += r["times"]
    assert +texts == Counter((r.doc_id, r.text) for r in mixing.taken(docs).collect())
    again = sorted(map(str, mixing.mix(docs.repartition(3)).select("doc_id", "taken").collect()))
    assert again == sorted(f"Row(doc_id={r['doc_id']}, taken={r['taken']})" for r in got)


def test_table(spark, sf):
    check(spark.read.parquet(f"{sf}/documents.parquet"), slack=0.05)


def test_odd(odd_docs, no_docs):
    check(odd_docs)
    assert mixing.mix(no_docs).count() == 0


def test_empty_source(spark):
    rows = [(1, "a", "x y z"), (2, "b", ""), (3, "b", None), (4, None, "q"), (5, "\U0001f600", "w w w w w w w w"), (6, "￿", "k k")]
    check(spark.createDataFrame(rows, "doc_id long, source string, text string"))


def test_fit_is_near():
    rng = np.random.default_rng(5)
    for _ in range(60):
        lengths = np.unique(rng.integers(1, 400, rng.integers(1, 40)))
        counts = rng.integers(1, 9, len(lengths))
        budget = int(rng.integers(0, (lengths * counts).sum() + 1))
        take = mixing.fit(lengths, counts, budget, capacity=int(rng.choice([4000, 1 << 15])))
        assert (take >= 0).all() and (take <= counts).all()
        reach = {0}
        for z, c in zip(lengths.tolist(), counts.tolist(), strict=True):
            if len(lengths) < 8:
                reach = {r + z * k for r in reach for k in range(c + 1)}
        if len(lengths) < 8:
            assert abs((lengths * take).sum() - budget) <= min(abs(r - budget) for r in reach) + lengths.min()


def test_many_sources(spark):
    rows = [(f"s{i}" if i % 50 else None if i else "x", (i * 37) % 101 + (5000 if i % 97 == 0 else 0)) for i in range(700)]
    sizes = spark.createDataFrame(rows, "source string, source_size long").groupBy("source").agg(mixing.F.sum("source_size").alias("source_size"))
    want = slow_targets({r.source: r.source_size for r in sizes.collect()})
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert got == {s: pytest.approx(t) for s, t in want.items()}
    assert mixing.targets(sizes.filter("false")).count() == 0


def test_maps_and_clashing_names(spark, odd_docs):
    docs = odd_docs.selectExpr("doc_id", "text", "source", "map('a', doc_id) as m", "h1 as _id", "row as _key", "size as _times", "1 as _rows")
    got = mixing.taken(docs)
    assert got.columns == docs.columns and got.count() > 0
