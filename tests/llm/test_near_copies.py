import random

from test_simhash import slow_classes as by_distance

from panelyard.llm import near_copies as N
from panelyard.llm.simhash import votes


def grams(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def slow(rows):
    """The classes of doc_ids, by plain search over all pairs of texts."""
    texts = sorted({(d, t) for d, t in rows if d is not None}, key=str)
    hashes = [N.shingles((t or "").encode()) for _, t in texts]
    sigs = [N.signature(N.minima(h)) for h in hashes]
    prints = [votes(h) for h in hashes]
    own = list(range(len(texts)))
    near = [[((a != b).sum() <= N.APART) or (x ^ y).bit_count() <= 3 for b, y in zip(sigs, prints, strict=True)] for a, x in zip(sigs, prints, strict=True)]
    for _ in texts:
        before = list(own)
        for i in range(len(texts)):
            own[i] = min(own[j] for j in range(len(texts)) if near[i][j])
        if own == before:
            break
    part = {}
    for (d, t), c in zip(texts, own, strict=True):
        part.setdefault(c, []).append((d, t))
    return [{d for d, _ in x} for x in part.values()]


def near_copies(seed=5, clusters=12):
    rng, rows = random.Random(seed), []
    for c in range(clusters):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice((60, 150, 400)))]
        rows.append((len(rows), " ".join(base)))
        for _ in range(6):
            new = list(base)
            for at in rng.sample(range(len(new)), max(1, len(new) // rng.choice((20, 40, 60, 90)))):
                new[at] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(new)))
    return rows


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in N.kept(docs, **options).collect()]
    assert sorted(d for d, _ in got) == sorted(min(part) for part in slow(rows))
    return got


def test_components_of_all_pairs(spark):
    rows = near_copies()
    left = {d for d, _ in check(spark, rows)}
    assert left == {d for d, _ in check(spark, rows, bucket=3)}
    sets = [grams(t) for _, t in rows]
    for i, x in enumerate(sets):
        for y in sets[:i]:
            if len(x & y) >= 0.85 * len(x | y):
                assert i not in left
    assert len(left) >= 12


def test_large_groups_of_copies(spark):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 400):
        new = list(base)
        for at in rng.sample(range(120), rng.choice((1, 2, 3, 4))):
            new[at] = f"x{rng.randrange(50)}"
        rows.append((i, " ".join(new)))
    check(spark, rows)
    check(spark, rows, bucket=20)


def test_rows_that_share_a_doc_id(spark):
    one, other = " ".join(f"a{i}" for i in range(80)), " ".join(f"b{i}" for i in range(80))
    docs = spark.createDataFrame([(1, one, "x"), (2, one, "x"), (2, other, "y"), (3, other, "z"), (None, one, "n")], "doc_id long, text string, _key string")
    got = sorted(map(tuple, N.kept(docs).collect()), key=str)
    assert got == sorted([(1, one, "x"), (2, other, "y"), (None, one, "n")], key=str)


def test_odd(spark, odd_docs, no_docs):
    assert N.kept(no_docs).count() == 0
    left = [r.doc_id for r in N.kept(odd_docs.withColumnsRenamed({"h1": "_ID", "row": "_gone"})).collect()]
    # 3, 4 and 5 have no words; 2 and 13 are copies, 8 and 9 near copies of 7; 11 and 12 are texts of their own.
    assert sorted(left, key=str) == sorted([1, 3, 6, 7, 10, 11, 12, None], key=str)


def test_linear_rows(spark, monkeypatch):
    """No step lists a bucket's pairs."""
    sizes = []
    real = N.store

    def counted(df, name):
        out = real(df, name)
        sizes.append((name, out.count()))
        return out

    monkeypatch.setattr(N, "store", counted)
    rng, base = random.Random(3), [f"w{i}" for i in range(100)]
    rows = []
    for i in range(600):
        new = list(base)
        for at in rng.sample(range(100), 3):
            new[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(new)))
    N.kept(spark.createDataFrame(rows, "doc_id long, text string")).count()
    assert max(n for _, n in sizes) <= 600 * N.BANDS


def test_distance_bound():
    assert by_distance([(1, 0), (2, 7), (3, 255)]) == {1: 1, 2: 1, 3: 3}
