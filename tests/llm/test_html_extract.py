import re

import numpy as np
import pytest

from panelyard.llm import html_extract as X


@pytest.mark.parametrize("page,texts", [
    ("", []), ("plain  text\n here", ["plain text here"]), ("<p>a<p>b<br>c</p>d", ["a", "b c", "d"]), ("<p>x &amp; y &#233;&lt; &am", ["x & y é< &am"]),
    ("<script>var t='</p>';<p>no</script><p>yes</p><style>p{}</style>", ["yes"]), ("<title>t</title><p>a <b>b</b><i>c</i> d", ["a bc d"]), ("<!-- <p>no</p> --><p>a<!-- x --></p>", ["a"]),
    ("<ul><li>a<li>b</ul><p title='a>b'>c</p>", ["a", "b", "c"]), ("<p>cut <a href=\"x", ["cut"]), ("<p>a</p><script>never closed <p>x", ["a"]), ("<select><option>a</select><p>1 < 2</p>", ["1 < 2"]),
    ("<table><tr><td>a</td><td>b</td></tr><tr><th>c</table>", ["a b", "c"]), ("<DIV CLASS=X>Up</DIV></div></p>tail", ["Up", "tail"]), ("a\u00a0&nbsp;b<hr>c", ["a b", "c"]),
])
def test_blocks(page, texts):
    assert [t for t, _, _ in X.blocks(page)] == texts


def test_held_out_pages():
    rng, right, total, whole = np.random.default_rng(1234), 0, 0, 0
    pages = [X.labelled(*X.make_page(rng, "named")) for _ in range(200)]
    for (_, y), got in zip(pages, X.label([p for p, _ in pages], X.model(), X.Vectors()), strict=True):
        right, total, whole = right + sum(got == np.array(y, bool)), total + len(y), whole + all(got == np.array(y, bool))
    assert right >= 0.985 * total and whole >= 0.85 * len(pages)


@pytest.mark.parametrize("family,least", [("named", 0.96), ("bare", 0.9), ("cells", 0.93), ("talk", 0.98)])
def test_layouts_never_seen(family, least):
    """A network trained without a family of layouts, on fresh pages of it."""
    assert X.accuracy(X.model(without=family), family) >= least


def test_words_of_long_blocks_count():
    path = (("div", ()),)
    one, other = (X.Vectors()([(" ".join([w] * 40), path, 0)])[0] for w in ("alpha", "beta"))
    assert (one != other).any() and one[X.PATH:X.PATH + X.WORD].sum() == pytest.approx(1)


def test_gradient():
    rng = np.random.default_rng(0)
    w = {k: rng.normal(0, 0.3, v.shape).astype(np.float64) for k, v in X.model().items()}
    x, lengths = rng.normal(0, 1, (5, 3, X.PATH + X.WORD + X.SHAPE)), np.array([5, 2, 4])
    y, mask = rng.integers(0, 2, (5, 3)), np.arange(5)[:, None] < lengths
    x = x * mask[:, :, None]

    def loss():
        p = 1 / (1 + np.exp(-X.predict(x, lengths, w)))
        return -(np.log(np.where(y == 1, p, 1 - p)) * mask).sum() / mask.sum()

    grad = X._gradient(x, y, mask, lengths, w)
    for k in w:
        at = tuple(rng.integers(0, s) for s in w[k].shape)
        old = w[k][at]
        w[k][at] = old + 1e-3
        up = loss()
        w[k][at] = old - 1e-3
        down = loss()
        w[k][at] = old
        assert grad[k][at] == pytest.approx((up - down) / 2e-3, abs=2e-3)


def article(page):
    """What the tables' pages hold between <article> and its end, taken apart by hand."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)
    out = []
    for part in re.split(r"</?(?:p|h1|h2)>", inner[1] if inner else ""):
        text = " ".join(X.html.unescape(re.sub(r"<[^>]*>", " " if "<br>" in part else "", part)).split())
        if text:
            out.append(text)
    return "\n".join(out)


def test_table(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    got = X.extract(pages).collect()
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)


def test_odd(spark):
    rows = [(1, None, None), (1, None, None), (None, "u", ""), (2, "u", "<p>" * 3000 + "deep"), (3, "u", "<" * 50000), (4, "u", "<article>" + "<p>Some words of an article, and more.</p>" * 3000 + "</article>"), (5, "u", "<a b='" * 2000)]
    got = X.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", X.F.lit(1))).collect()
    assert len(got) == 7 and [r.text for r in got if r.page_id == 1] == ["", ""]
    assert next(r for r in got if r.page_id == 4).text.count("\n") == 2999
    assert X.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
