import math
import re

import pytest
from pyspark.sql import functions as F

from panelyard.llm import quality_rules as Q


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {w for w in windows if windows.count(w) > 1} if len(words) < 3000 else {w for w, n in __import__("collections").Counter(windows).items() if n > 1}
    covered = {j for i, w in enumerate(windows) if w in often for j in (i, i + 1, i + 2)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in Q.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)


def check(docs, labels):
    rows = sorted(((r.doc_id, *slow(r.text)) for r in docs.select("doc_id", "text").collect()), key=str)
    got = Q.judge(docs, labels).collect()
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=str) == rows
    assert all(not (r.base_failed and r.kept) and r.kept == (r.rejected_by is None) for r in got)
    left = Q.kept(docs, labels)
    assert left.columns == docs.columns
    assert sorted(map(str, [r.doc_id for r in left.collect()])) == sorted(str(r.doc_id) for r in got if r.kept)
    return got


def test_table(spark, sf):
    check(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))


def test_odd(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, None), (99, 1, 0)], "doc_id long, quality int, toxic int")
    check(odd_docs, labels)
    assert check(no_docs, labels) == []
    check(odd_docs, labels.limit(0))


def tail(n, k, a):
    return sum(math.comb(n, j) * a**j * (1 - a) ** (n - j) for j in range(k + 1))


@pytest.mark.parametrize("n,k,a", [(10, 0, 0.1), (1000, 3, 0.004), (5000, 12, 0.004), (300, 1, 0.01), (50, 0, 0.004)])
def test_tail(spark, n, k, a):
    got = spark.range(1).select(Q._tail(F.lit(n).cast("long"), F.lit(k).cast("long"), a)).first()[0]
    assert got == pytest.approx(tail(n, k, a)) or k >= n * a and got == 1


def test_cutoffs_keep_their_promise(spark):
    rows = []
    for i in range(4000):
        symbols = "# " * (40 if i % 40 == 0 else 0)
        rows.append((i, symbols + " ".join(f"w{i}x{j}" for j in range(60)), "en"))
    for i in range(4000, 4200):
        rows.append((i, "#### " * 20 + " ".join(f"w{i}x{j}" for j in range(60)), "en"))
    rows.append((9000, rows[-1][1], "zz"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (F.col("doc_id") < 4000).cast("int").alias("quality"))
    got = {r.doc_id: r for r in Q.judge(docs, labels).collect()}
    # 100 good documents have 0.4 symbols a word, too many for the sets from 0.3 on.
    assert [tail(4000, 100 * (own["symbols"] < 0.4), 0.02) <= 0.05 for own in Q.rule_sets()] == [True] * 3 + [False] * 3
    assert all(got[d].kept for d in range(4000))
    assert all(not got[d].kept and got[d].rejected_by == "symbols" for d in range(4000, 4200))
    assert got[9000].kept


def test_small_strata(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(60)), "de") for i in range(300)]
    rows += [(i, "#### " * 20 + " ".join(f"w{i}x{j}" for j in range(60)), "de") for i in range(300, 320)]
    rows += [(i, t, "fr") for i, t, _ in rows[:100]]
    docs = spark.createDataFrame([(at, t, lang) for at, (_, t, lang) in enumerate(rows)], "doc_id long, text string, lang string")
    labels = docs.filter("lang = 'fr' or doc_id < 300").select("doc_id", F.lit(1).alias("quality"))
    left = {r.doc_id for r in Q.kept(docs, labels).collect()}
    assert left == set(range(420)) - set(range(300, 320))
    # 100 good documents are too few for the promise: 0.98 ** 100 is above the error level.
    found = {r.stratum: r for r in Q.cutoffs(Q.counts(docs.withColumnRenamed("lang", "stratum")).withColumn("base_failed", F.lit(False)), labels).collect()}
    assert found["fr"].cut_symbols is None and found["de"].cut_symbols == Q.RULES["symbols"][1][-1]
