import re
import textwrap

import pytest

from panelyard.llm import license_scan as L

TEMPLATES = L.templates()


def words(text):
    return re.sub(r"[^\w]|_", " ", (text or "").lower()).split()


def grams(w):
    return [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]


def slow(text, threshold=L.THRESHOLD):
    own, hits, found = grams(words(text)), [], set()
    for at, (name, template) in enumerate(TEMPLATES):
        b, n = set(grams(words(template))), len(words(template))
        for i, first in enumerate(own):
            if first in b:
                a = set(own[i:i + n - 1])
                score = 2 * len(a & b) / (len(a) + len(b))
                if score >= threshold:
                    hits.append((-score, i, at, name))
                    found.add(at)
    if not hits:
        return 0, None, None, None
    s, i, _, name = min(hits)
    return len(found), name, -s, i + 1


def check(docs):
    want = sorted(((r.doc_id, *slow(r.text)) for r in docs.select("doc_id", "text").collect()), key=str)
    got = L.scan(docs).select("doc_id", "n_matches", "license", "score", "word").collect()
    assert sorted(map(tuple, got), key=str) == want
    return want


def test_table(spark, sf):
    assert any(r[1] for r in check(spark.read.parquet(f"{sf}/documents.parquet")))


def test_variants(spark, odd_docs, no_docs):
    check(odd_docs)
    check(no_docs)
    texts = [
        "x\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0.", "RELEASED, under; the mit-license!", "Released under MIT License", "Released under the the MIT License.",
        "released under the mit license released under the mit license", "We released under the MIT License yesterday a long tale of things", "Licensed under CC BY\nNC 4.0.", "\n\n", "MIT",
        "Licensed under the Apache License Version 2.0 (the License)", "This work is licensed under the GNU General Public License version 2", "redistribution and use in source and binary forms with or without modification are permitted",
        "Released\tunder the MIT\r\nLicense", "é Released under the MIT License.", "This project is released under the MIT License."]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


@pytest.mark.parametrize("width", [30, 60, 72, 79])
def test_wrapped_and_inside_prose(spark, width):
    rows = []
    for name, text in TEMPLATES:
        before = " ".join(f"before{i}" for i in range(40))
        rows += [(name, textwrap.fill(text, width, break_long_words=False)), (name, before + " " + textwrap.fill(text, width, break_long_words=False, initial_indent=" * ", subsequent_indent=" * ") + " " + before)]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r for r in L.scan(docs).collect()}
    assert all(got[i].license == name and got[i].score == 1.0 and got[i].word in (1, 41) for i, (name, _) in enumerate(rows))


def test_changed_texts(spark):
    name, text = TEMPLATES[-4]
    w = text.split()
    some = [(0, " ".join(x for i, x in enumerate(w) if i % 25)), (1, " ".join(x for i, x in enumerate(w) if i % 3)), (2, " ".join(w[:40])), (3, " ".join([*w, "and", *w]))]
    check(spark.createDataFrame(some, "doc_id long, text string"))
    assert slow(some[0][1])[1] == name and slow(some[1][1])[1] is None


def test_every_match_has_a_mark():
    own = [L._Template(*x, L.THRESHOLD) for x in TEMPLATES]
    marks = set(L._marks(own))
    assert all(sum(not set(g.split()) & marks for g in t.grams) < t.need for t in own)
