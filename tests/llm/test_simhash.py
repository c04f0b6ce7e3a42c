import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from panelyard.llm import simhash
from panelyard.llm.components import components


def slow_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(rows, radius=3):
    """rows: (doc_id, print); the smallest doc_id reachable, by plain search."""
    own = {d: d for d, _ in rows if d is not None}
    changed = True
    while changed:
        changed = False
        for a, x in rows:
            for b, y in rows:
                if a is not None and b is not None and (x ^ y).bit_count() <= radius and own[b] < own[a]:
                    own[a], changed = own[b], True
    return own


def check(docs):
    rows = [(r.doc_id, slow_print(r.text)) for r in docs.select("doc_id", "text").collect()]
    own = slow_classes(rows)
    by_print = {}
    for d, p in rows:
        if d is not None:
            by_print[p] = own[d]
    got = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect()]
    want = [(d, p, own[d] if d is not None else by_print.get(p)) for d, p in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_table(spark, sf):
    check(spark.read.parquet(f"{sf}/documents.parquet"))


def test_odd(odd_docs):
    check(odd_docs)


def test_empty(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0


def test_fingerprint_is_sparks_hash(spark):
    text = "a b c"
    h = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % (1 << 64)
    assert simhash.fingerprint(text.encode()) == h


def test_masks_cover_every_pair():
    rng = random.Random(1)
    for q, tables in ((2, 15), (5, 156)):
        masks = simhash.masks(3, q)
        assert len(masks) == tables
        for _ in range(500):
            flipped = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
            assert any(m & flipped == 0 for m in masks)


def test_large_buckets_lose_nothing(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 62, 40)
    rows = {0: 0}
    for i in range(1, 900):
        x = int(centres[rng.integers(40)])
        for b in rng.integers(0, 64, rng.integers(0, 4)):
            x ^= 1 << int(b)
        rows[i] = x
    seen = {}
    for d, p in rows.items():
        seen.setdefault(p, d)
    prints = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, d) for p, d in seen.items()], "fp long, rep long")
    own = slow_classes([(d, p) for p, d in seen.items()])
    for bucket in (3, 2000):
        got = dict(components(simhash.link(prints, 3, bucket)).collect())
        assert {d: got.get(d, d) for d in own} == own


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 200)] + [(500, 499), (7, 7)], "u long, v long")
    got = dict(components(edges).collect())
    assert got == {i: 0 for i in range(201)} | {499: 499, 500: 499}
    assert components(edges.filter("u < 0")).count() == 0


def test_second_deal_is_bounded():
    assert max(64 - m.bit_count() for m in simhash.masks(3, 5)) == 21
