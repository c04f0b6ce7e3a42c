import math
from collections import Counter
from pathlib import Path

import pytest

from panelyard.llm import lm_score as M


def slow(rows, order, least):
    docs = [(d, (t or "").encode().split()) for d, t in rows]
    counts = [Counter(tuple(w[i:i + n]) for _, w in docs for i in range(len(w) - n + 1)) for n in range(1, order + 1)]
    total = sum(counts[0].values())
    out = []
    for d, w in docs:
        s = 0.0
        for i in range(len(w)):
            for n in range(order, 0, -1):
                gram = tuple(w[i - n + 1:i + 1]) if i - n + 1 >= 0 else None
                c = counts[n - 1].get(gram, 0) if gram else 0
                if n == 1 or c >= least:
                    s += math.log10(c / (total if n == 1 else counts[n - 2][gram[:-1]])) + (order - n) * math.log10(M.BACKOFF)
                    break
        out.append((d, len(w), s))
    return out


def check(docs, order=2, least=2, **sizes):
    want = sorted(slow([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], order, least), key=str)
    got = sorted(((r.doc_id, r.n_words, r.log10_score, r.mean_log10) for r in M.score(docs, order, least, **sizes).collect()), key=str)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want])
    assert all(m == (pytest.approx(s / n) if n else None) for _, n, s, m in got)


def test_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check(docs, 3)
    check(docs, 3, 2, block=5000, part=3000)
    check(docs, 2, 3, block=20_000, part=9000)
    check(docs.repartition(5), 1, 1, block=700, part=500)


def test_intermediate_tables_go(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = []
    real = M.store
    M.store = lambda df, name: seen.append(real(df, name)) or seen[-1]
    try:
        M.score(docs, 4, block=5000).count()
    finally:
        M.store = real
    assert [Path(s.stored_at.removeprefix("file:")).exists() for s in seen] == [False] * (len(seen) - 2) + [True, True]


def test_odd(odd_docs, no_docs):
    check(odd_docs)
    check(odd_docs, 4, 1, block=50, part=40)
    assert M.score(no_docs).count() == 0
    check(odd_docs.filter("text is null or doc_id in (4, 5)"))
