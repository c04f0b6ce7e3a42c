import hashlib

from panelyard.llm import substring_dedup as S


def lows(rows, length):
    """The smallest doc_id of every window."""
    windows = {}
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - length + 1):
            k = tuple(w[i:i + length])
            if d is not None:
                windows[k] = min(d, windows.get(k, d))
    return windows


def late(d, w, windows, length):
    return [i for i in range(len(w) - length + 1) if d is not None and windows[tuple(w[i:i + length])] < d]


def slow(rows, length):
    sizes, longest = [length], {}
    while any(len((t or "").encode().split()) >= sizes[-1] for _, t in rows):
        windows = lows(rows, sizes[-1])
        found = [late(d, (t or "").encode().split(), windows, sizes[-1]) for d, t in rows]
        if sizes[-1] == length:
            places = found
        if not any(found):
            break
        longest |= {i: sizes[-1] for i, x in enumerate(found) if x}
        sizes.append(2 * sizes[-1])
    out = []
    for n, (d, t) in enumerate(rows):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in places[n] if len(w) >= length else ():
            gone[i:i + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest(), longest.get(n, 0)))
    return sorted(out, key=str)


def check(docs, length=50):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = S.remove_repeats(docs, length, render=S.digest_of).select("doc_id", "n_words", "n_removed", "kept_sha256", "longest").collect()
    want = slow(rows, length)
    assert sorted(map(tuple, got), key=str) == want
    return sum(r[2] for r in want)


def test_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check(docs)
    assert check(docs, 7) > 0


def test_odd(odd_docs):
    assert check(odd_docs) > 0
    check(odd_docs.filter("doc_id is null or doc_id not in (6, 13)"), 9)


def test_repeated_ids_and_words(spark):
    same = "x " * 70
    rows = [(5, same), (5, "a " + same), (4, "y " * 55), (6, same + "end"), (6, "y " * 52), (5, same), (None, same)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), 50)
    check(spark.createDataFrame(rows, "doc_id long, text string"), 2)


def test_text(odd_docs, no_docs):
    cut = S.remove_repeats(odd_docs)
    got = {r.doc_id: r for r in cut.collect()}
    assert got[8].text == " and more".strip() and got[8].n_removed == 60 and got[8].h1 is None
    assert got[9].text == "tail" and got[7].n_removed == 0 and got[7].text.startswith("start here\nshared0")
    assert got[3].text is None and got[2].text == "" and got[1].n_removed == 0
    assert S.remove_repeats(no_docs).count() == 0
    assert cut.columns == [*odd_docs.columns, "n_removed", "longest"]


def slow_levels(rows, length):
    out, texts = set(), {d: (t or "").split() for d, t in rows if d is not None}
    while True:
        places = {}
        for d, w in texts.items():
            for i in range(len(w) - length + 1):
                places.setdefault(tuple(w[i:i + length]), []).append((d, i))
        now = {p for ps in places.values() if len({d for d, _ in ps}) > 1 for p in ps}
        if not now:
            return {(n, d, i) for n, d, i in out if (2 * n, d, i) not in out}
        out |= {(length, d, i) for d, i in now}
        length *= 2


def test_levels(spark, sf, odd_docs, no_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for df, length in ((docs, 6), (docs, 50), (odd_docs.dropDuplicates().filter("doc_id < 13"), 9), (no_docs, 5)):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        got = S.repeat_levels(df, length).select("length", "doc_id", "at").collect()
        assert {tuple(r) for r in got} == slow_levels(rows, length) and len(got) == len({tuple(r) for r in got})


def test_columns_with_the_same_names(odd_docs):
    docs = odd_docs.filter("doc_id < 13 and doc_id <> 6").withColumnsRenamed({"h1": "n_removed", "row": "longest", "size": "_d"})
    cut = S.cut_texts(docs)
    got = {r.doc_id: r for r in cut.collect()}
    assert cut.columns == docs.columns and got[8].text == "and more" and got[8].n_chars == 8
    assert (got[1].n_removed, got[1].longest, got[1]._d) == ("x", "y", "z") and got[7].n_chars == 1
