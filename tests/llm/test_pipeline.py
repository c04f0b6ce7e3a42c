"""Each stage against a brute-force version of it, on its own input; and the queries' columns."""

from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_mixing import slow_targets
from test_near_copies import slow as slow_classes
from test_quality_rules import slow as slow_counts
from test_substring_dedup import slow as slow_removed

import corpus_pipeline as P
from panelyard.llm import packing, queries
from panelyard.llm._shared import store

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.fixture(scope="module")
def stages(spark, sf):
    """The input and every stage's output."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(store(stage(spark, out[-1], sf), name))
    return out


def test_stages_are_named_and_keep_the_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality", "near_dedup", "substring", "mix", "pack"]
    assert all(s.columns == COLUMNS and s.dtypes == stages[0].dtypes for s in stages[:-1])


def test_quality(stages):
    # With as few labels as here no cutoff has a guarantee: what passes the base rules stays, as it is.
    want = [r for r in rows(stages[0]) if not slow_counts(r["text"])[-1]]
    assert sorted(map(str, rows(stages[1]))) == sorted(map(str, want)) and 0 < len(want) < stages[0].count()


def test_near_dedup(stages):
    before = rows(stages[1])
    left = {min(part) for part in slow_classes([(r["doc_id"], r["text"]) for r in before])}
    assert sorted(map(str, rows(stages[2]))) == sorted(str(r) for r in before if r["doc_id"] in left)


def test_substring(stages):
    before, after = rows(stages[2]), {r["doc_id"]: r for r in rows(stages[3])}
    removed = {d: n for d, _, n, _, _ in slow_removed([(r["doc_id"], r["text"]) for r in before], 50)}
    assert len(after) == len(before)
    for r in before:
        now = after[r["doc_id"]]
        assert len((now["text"] or "").split()) == len((r["text"] or "").split()) - removed[r["doc_id"]]
        assert now == r if not removed[r["doc_id"]] else now["n_chars"] == len(now["text"])


def test_mix(stages):
    before, after = rows(stages[3]), rows(stages[4])
    size = lambda r: len((r["text"] or "").encode().split())
    times = Counter(r["doc_id"] for r in after)
    assert {str(r) for r in after} <= {str(r) for r in before} and max(times.values()) <= 3
    sizes, got = Counter(), Counter()
    for r in before:
        sizes[r["source"]] += size(r)
        got[r["source"]] += size(r) * times[r["doc_id"]]
    for s, t in slow_targets(dict(sizes)).items():
        assert abs(got[s] - t) <= 0.05 * max(1, t) + min((size(r) for r in before if r["source"] == s), default=0)


def test_pack(stages):
    encode = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in rows(stages[4]):
        n = len(encode(r["text"])) // 4
        want.update((r["doc_id"], p, at, min(2048, n - at)) for p, at in enumerate(range(0, n, 2048)))
    got = rows(stages[5])
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"]) for r in got) == want
    full = {}
    for r in got:
        full.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all([o for o, _ in sorted(x)] == [sum(n for _, n in sorted(x)[:i]) for i in range(len(x))] and sum(n for _, n in x) <= 2048 for x in full.values())


def test_run_is_the_stages(spark, sf, stages):
    got = P.run(spark, sf)
    assert got.columns == stages[-1].columns and got.count() == stages[-1].count()


def test_stages_take_odd_and_empty_tables(spark, sf, odd_docs, no_docs):
    for docs in (odd_docs.select(*COLUMNS), no_docs.select(*COLUMNS)):
        for name, stage in P.STAGES:
            out = store(stage(spark, docs, sf), name)
            assert name == "pack" or out.columns == COLUMNS
            docs = out
    assert docs.count() == 0


def test_stages_take_columns_with_any_names(spark, sf, odd_docs):
    names = ["_id", "_key", "_gone", "_times", "_rows", "_text", "n_removed", "longest", "row_key", "stratum", "h", "_w"]
    docs = odd_docs.filter("doc_id < 13 and doc_id <> 6").selectExpr(*COLUMNS, *[f"'{n}' as {n}" for n in names], "map('a', lang) as m")
    for name, stage in P.STAGES[:-1]:
        out = store(stage(spark, docs, sf), name)
        assert out.columns == docs.columns and all(r[n] == n for r in out.collect() for n in names)
        docs = out
    assert P.STAGES[-1][1](spark, docs, sf).count() == docs.count()


def test_queries(spark, sf):
    want = {
        "op1_url_filter": {"page_id", "host", "path", "rule", "verdict"}, "op2_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}, "op3_license_scan": {"doc_id", "license"},
        "op4_substring_dedup": {"doc_id", "n_words", "n_removed", "kept_sha256", "longest"}, "op5_simhash": {"doc_id", "fingerprint", "component_id"}, "op6_lm_score": {"doc_id", "log10_score"},
        "op7_html_extract": {"page_id", "url", "text", "n_chars"}, "op8_ann": {"query_id", "rank", "vec_id", "score"}, "op9_quality_rules": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
        "op10_mixing": {"doc_id", "size", "source_size", "target", "taken"}, "pipeline": {"doc_id", "sequence_id"}}
    found = queries.queries()
    assert set(found) == set(want) and set(queries.oracle_sql()) <= set(want)
    for name, columns in want.items():
        assert columns <= set(found[name](spark, sf).columns)
    prints = found["op5_simhash"](spark, sf)
    assert prints.filter(~F.col("fingerprint").rlike("^[0-9a-f]{16}$")).isEmpty()
