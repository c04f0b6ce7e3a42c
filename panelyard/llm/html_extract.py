"""Main-text extraction: a bidirectional LSTM labels every block of a page.

A page is cut into its leaf blocks, runs of text between block-level tags.  Each
block becomes a vector: hashed tags, classes and ids of the elements around it,
all its words hashed (at unit length), and a few shapes (length, share of links, place).  The network, plain
numpy, reads a page's whole sequence forwards and backwards, so that each block is
judged in the context of the document, and blocks judged as article are joined.

The network is trained here, on pages that ``make_page`` composes from the usual
parts of web pages in several families of layout (their number is the parameter ``pages``); it
depends on nothing but the seed, so every run has the same one.  ``model(without=...)`` leaves a
family out, and ``accuracy`` measures on it how the labeller does on layouts never seen.
"""

from __future__ import annotations

import html
import re
import zlib
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATH, WORD, SHAPE, HIDDEN = 96, 32, 8, 16
#: Composed pages the network is fitted on, and passes over them.
PAGES, EPOCHS, SEED = 1500, 10, 5

# Elements of HTML by how they lay out text.
BLOCKS = frozenset("""address article aside blockquote body button caption dd details dialog dir div dl dt fieldset figcaption figure footer
form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table
tbody tfoot thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TEXT = frozenset("script style textarea title noscript iframe template svg math object select head datalist".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
CLOSES_P = BLOCKS - {"body", "html", "button", "option", "optgroup", "select"}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PIECE = re.compile(r"[a-z]+")


def blocks(page: str) -> list[tuple[str, tuple, int]]:
    """The leaf blocks in page order: (text, names of the elements around it, characters inside links).

    Character references are decoded, white space is one space; text of scripts, styles,
    forms' choices and the head is none of the page's.  Elements left open are closed by their
    parent, paragraphs and list items also by the next; a tag cut off by the end is dropped.
    """
    out: list[tuple[str, tuple, int]] = []
    stack: list[tuple[str, tuple]] = []
    parts: list[str] = []
    linked, links = 0, 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text and not any(t in HIDDEN_TEXT for t, _ in stack):
                out.append((text, tuple(stack), min(linked, len(text))))
        parts.clear()
        linked = 0

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        text = page[at:m.start() if m else end]
        if text:
            parts.append(text)
            if links:
                linked += len(text.strip())
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            if name in BLOCKS:
                flush()
            elif name in ("td", "th"):
                parts.append(" ")
            elif name == "a":
                links = max(0, links - 1)
            if any(t == name for t, _ in stack):
                while stack.pop()[0] != name:
                    pass
            continue
        attributes = m[3] or m[6] or ""
        if name in RAW:
            close = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else end
            if name in ("title",):
                flush()
            continue
        if name in BLOCKS:
            flush()
            links = 0
            if name in CLOSES_P and stack and stack[-1][0] == "p":
                stack.pop()
            if name in ("li", "option", "tr", "dt", "dd") and stack and stack[-1][0] == name:
                stack.pop()
        elif name in ("br", "td", "th", "img", "input"):
            parts.append(" ")
        elif name == "a":
            links += 1
        if name not in VOID and not attributes.rstrip().endswith("/") and (name in BLOCKS or name in HIDDEN_TEXT):
            names = tuple(w for g in _NAMES.findall(attributes) for w in _PIECE.findall("".join(g).lower())) if "=" in attributes else ()
            stack.append((name, names))
    flush()
    return out


def _slot(word: str, size: int) -> int:
    return zlib.crc32(word.encode()) % size


@cache
def _element(name: str, names: tuple) -> np.ndarray:
    v = np.zeros(PATH, np.float32)
    for key in (f"<{name}", *(f".{n}" for n in names)):
        h = zlib.crc32(key.encode())
        v[h % PATH] += 1
        v[(h >> 8) % PATH] += 1 if h >> 20 & 1 else -1
    return v


class Vectors:
    """Vectors of a page's blocks."""

    def __init__(self):
        self.paths, self.words = {}, {}

    def __call__(self, page: list) -> np.ndarray:
        x = np.zeros((len(page), PATH + WORD + SHAPE), np.float32)
        if len(self.paths) > 50_000:
            self.paths.clear()
        if len(self.words) > 200_000:
            self.words.clear()
        for i, (text, path, linked) in enumerate(page):
            v = self.paths.get(path)
            if v is None:
                v = sum((_element(t, n) for t, n in path if t not in ("html", "body")), np.zeros(PATH, np.float32))
                self.paths[path] = v = np.tanh(v)
            x[i, :PATH] = v
            words = text.lower().split()
            slots = []
            for w in words:
                s = self.words.get(w)
                if s is None:
                    s = self.words[w] = _slot(w, WORD)
                slots.append(s)
            n = len(words)
            hashed = np.bincount(slots, minlength=WORD)
            x[i, PATH:PATH + WORD] = hashed / np.sqrt((hashed * hashed).sum())
            tag = path[-1][0] if path else ""
            x[i, PATH + WORD:] = (np.log1p(n) / 4, linked / len(text), text[-1] in ".!?:;\"", tag[:1] == "h" and tag[1:].isdigit(), tag == "p", n < 6, min(i, 10) / 10, min(len(page) - 1 - i, 10) / 10)
        return x


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _run(x: np.ndarray, w: dict, d: str, keep: bool):
    """One direction over x (steps, pages, inputs); with ``keep`` also what the gradient needs."""
    steps, pages, _ = x.shape
    a = x @ w["x" + d] + w["b" + d]
    h = np.zeros((steps + 1, pages, HIDDEN), np.float32)
    c = np.zeros((steps + 1 if keep else 1, pages, HIDDEN), np.float32)
    kept = []
    now = c[0]
    for t in range(steps):
        g = a[t] + h[t] @ w["h" + d]
        s = _sigmoid(g[:, :3 * HIDDEN])
        u = np.tanh(g[:, 3 * HIDDEN:])
        now = s[:, HIDDEN:2 * HIDDEN] * now + s[:, :HIDDEN] * u
        y = np.tanh(now)
        h[t + 1] = s[:, 2 * HIDDEN:] * y
        if keep:
            c[t + 1] = now
            kept.append((s, u, y))
    return h, c, kept


def _turned(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Every page's steps in reverse order, padding left behind."""
    steps = np.arange(x.shape[0])[:, None]
    at = np.where(steps < lengths, lengths - 1 - steps, steps)
    return np.take_along_axis(x, at[:, :, None], axis=0)


def predict(x: np.ndarray, lengths: np.ndarray, w: dict) -> np.ndarray:
    """Logits (steps, pages) for padded x (steps, pages, inputs)."""
    f = _run(x, w, "f", False)[0][1:]
    b = _turned(_run(_turned(x, lengths), w, "b", False)[0][1:], lengths)
    return (np.concatenate([f, b], 2) @ w["o"] + w["c"])[:, :, 0]


def _back(x, w, d, run, dh, grad):
    h, c, kept = run
    da = np.empty((*x.shape[:2], 4 * HIDDEN), np.float32)
    dn, dc = np.zeros_like(dh[0]), np.zeros_like(dh[0])
    for t in reversed(range(len(kept))):
        s, u, y = kept[t]
        i, f, o = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:]
        dy = dh[t] + dn
        dc = dc + dy * o * (1 - y * y)
        da[t] = np.concatenate([dc * u * i * (1 - i), dc * c[t] * f * (1 - f), dy * y * o * (1 - o), dc * i * (1 - u * u)], 1)
        dn, dc = da[t] @ w["h" + d].T, dc * f
    flat = da.reshape(-1, 4 * HIDDEN)
    grad["x" + d] = x.reshape(-1, x.shape[2]).T @ flat
    grad["h" + d] = h[:-1].reshape(-1, HIDDEN).T @ flat
    grad["b" + d] = flat.sum(0)


def _gradient(x, y, mask, lengths, w):
    turned = _turned(x, lengths)
    f, b = _run(x, w, "f", True), _run(turned, w, "b", True)
    both = np.concatenate([f[0][1:], _turned(b[0][1:], lengths)], 2)
    p = _sigmoid((both @ w["o"] + w["c"])[:, :, 0])
    d = ((p - y) * mask / mask.sum())[:, :, None].astype(np.float32)
    grad = {"o": both.reshape(-1, 2 * HIDDEN).T @ d.reshape(-1, 1), "c": d.sum((0, 1))}
    dh = d * w["o"][:, 0]
    _back(x, w, "f", f, dh[:, :, :HIDDEN], grad)
    _back(turned, w, "b", b, _turned(dh[:, :, HIDDEN:], lengths), grad)
    return grad


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(p) for p in pages])
    x = np.zeros((lengths.max(), len(pages), pages[0].shape[1]), np.float32)
    for j, p in enumerate(pages):
        x[:len(p), j] = p
    return x, lengths


@cache
def model(pages: int = PAGES, epochs: int = EPOCHS, seed: int = SEED, without: str | None = None) -> dict:
    """The network's weights after training on ``pages`` composed pages, of all families but one."""
    rng = np.random.default_rng(seed)
    vectors, data = Vectors(), []
    kinds = [f for f in FAMILIES if f != without]
    share = np.array([FAMILIES[f] for f in kinds]) / sum(FAMILIES[f] for f in kinds)
    for _ in range(pages):
        found, labels = labelled(*make_page(rng, str(rng.choice(kinds, p=share))))
        if found:
            data.append((vectors(found), np.array(labels, np.float32)))
    size = PATH + WORD + SHAPE
    w = {}
    for d in "fb":
        w["x" + d] = rng.normal(0, size**-0.5, (size, 4 * HIDDEN)).astype(np.float32)
        w["h" + d] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        w["b" + d] = np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)].astype(np.float32)
    w["o"] = rng.normal(0, 0.2, (2 * HIDDEN, 1)).astype(np.float32)
    w["c"] = np.zeros(1, np.float32)
    first, second, step = {k: 0 for k in w}, {k: 0 for k in w}, 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs)
        order = sorted(rng.permutation(len(data)).tolist(), key=lambda i: len(data[i][0]) // 8)
        batches = [order[i:i + 24] for i in range(0, len(order), 24)]
        for j in rng.permutation(len(batches)):
            x, lengths = _padded([data[i][0] for i in batches[j]])
            y, _ = _padded([data[i][1][:, None] for i in batches[j]])
            mask = np.arange(x.shape[0])[:, None] < lengths
            grad = _gradient(x, y[:, :, 0], mask, lengths, w)
            step += 1
            for k, g in grad.items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                w[k] = w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return {k: v.astype(np.float32) for k, v in w.items()}


def label(pages: list[list], w: dict, vectors: Vectors, step: int = 64) -> list[np.ndarray]:
    """For each page's blocks whether they are main text."""
    out: list = [np.zeros(0, bool)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):
        own = order[at:at + max(1, min(step, 60_000 // len(pages[order[min(at + step, len(order)) - 1]])))]
        at += len(own)
        x, lengths = _padded([vectors(pages[i]) for i in own])
        logits = predict(x, lengths, w)
        for j, i in enumerate(own):
            out[i] = logits[:lengths[j], j] > 0
    return out


def _extracted(batches, w):
    vectors = Vectors()
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            pages = [blocks(h or "") for h in part.column(2).to_pylist()]
            texts = ["\n".join(b[0] for b, y in zip(p, ys, strict=True) if y) for p, ys in zip(pages, label(pages, w, vectors), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages``, from the whole html.

    Null and empty html, and pages without main text, give an empty text.  Repeated rows stay.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(partial(_extracted, w=model()), "page_id long, url string, text string, n_chars long")


# Pages for training: usual parts of web pages with their usual names.

# Element names and words that web pages commonly give to their parts.
MAIN = ("article", "main", "div.content", "div#content", "div.post", "div.post-body", "div.entry-content", "section.article-body", "div.article", "div.story", "div#main", "article.post", "div.page-content", "div.article-text", "section.main")
MENU = ("nav", "div.menu", "ul.nav", "div.navbar", "div#menu", "nav.main-nav", "div.breadcrumbs", "ul.breadcrumb", "div.toolbar", "div.topnav", "div.navigation")
HEAD = ("header", "div.header", "div#header", "div.masthead", "div.banner", "div.topbar", "div.site-header")
FOOT = ("footer", "div.footer", "div#footer", "div.site-footer", "div.copyright", "div.legal", "div.bottom")
SIDE = ("aside", "div.sidebar", "div#sidebar", "div.widget", "aside.related", "div.related", "div.recommended", "div.trending", "section.sidebar", "div.popular", "div.side")
NOTICE = ("div.cookie", "div.cookie-notice", "div#consent", "div.alert", "div.notice", "div.popup", "div.modal", "div.gdpr", "div.cookie-banner", "div.disclaimer", "div.overlay", "div.paywall")
ADS = ("div.ad", "div.ads", "div.advert", "div.advertisement", "div.sponsored", "div.promo", "aside.ad", "div#ad", "div.banner-ad", "section.promo", "div.sponsor", "p.ad")
TALK = ("section.comments", "div#comments", "div.comments", "ol.commentlist", "div.comment", "div.discussion", "div.replies", "section#comments", "ul.comments", "div.respond", "div.reviews")
FORM = ("form", "form.search", "div.newsletter", "form.subscribe", "div.signup", "div.login", "form#contact", "div.search", "form.newsletter")
SHARE = ("div.share", "div.social", "ul.share", "div.tags", "div.meta", "div.byline", "div.author-bio", "div.pagination", "div.social-links")
TALKING = "menu home about contact login share tweet copyright rights reserved privacy terms cookies accept subscribe newsletter search reply comment comments posted related more read sponsored advertisement next previous follow us sign up email".split()


def _words(rng, n, odd=0.0):
    syllables = ("th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti", "to", "it", "st", "io", "le", "is", "ou", "ar", "as", "de", "rt", "ve", "ü", "é", "ción", "sch")
    out = []
    for _ in range(n):
        out.append(str(rng.choice(TALKING)) if rng.random() < odd else "".join(rng.choice(syllables, rng.integers(1, 5))))
    return " ".join(out)


def _sentences(rng, n, odd=0.0):
    text = _words(rng, n, odd)
    return text.capitalize() + (str(rng.choice([".", ".", ".", "!", "?", ""])))


#: Kinds of layout, and their shares of the training pages: parts with telling names; the same without class names and
#: sectioning elements; cells of a layout table; readers' comments inside the article's element.
FAMILIES = {"named": 0.7, "bare": 0.1, "cells": 0.1, "talk": 0.1}


def _bare(rng, page: str, cells: bool) -> str:
    """The page with sectioning elements as plain ones, or as cells, and without its names."""
    page = re.sub(r' (?:class|id)="[^"]*"', lambda m: "" if cells or rng.random() < 0.5 else f' class="{_words(rng, 1)}"', page)
    start, end = ("<table><tr><td>", "</td></tr></table>") if cells else ("<div>", "</div>")
    page = re.sub(r"<(?:article|main|nav|header|footer|aside|section|form)( [^>]*)?>", lambda m: start if cells else f"<div{m[1] or ''}>", page)
    return re.sub(r"</(?:article|main|nav|header|footer|aside|section|form)>", end, page)


def make_page(rng, family: str | None = None) -> tuple[str, set]:
    """A composed page of a family, by default a random one, and the texts of its main blocks."""
    family = family or str(rng.choice(list(FAMILIES), p=list(FAMILIES.values())))
    main: set[str] = set()

    def tag(spec, inner):
        name, mark, value = re.match(r"(\w+)([.#]?)(.*)", spec).groups()
        extra = "" if not mark else f' class="{value}"' if mark == "." else f' id="{value}"'
        return f"<{name}{extra}>{inner}</{name}>"

    def links(n, close=True):
        items = [f'<a href="/{i}">{_words(rng, int(rng.integers(1, 4)), 0.3)}</a>' for i in range(n)]
        kind = rng.random()
        if kind < 0.6:
            return "<ul>" + "".join(f"<li>{x}" + ("</li>" if close else "") for x in items) + "</ul>"
        return " | ".join(items) if kind < 0.8 else "".join(f"<div>{x}</div>" for x in items)

    def prose(n, odd=0.05):
        return "".join(f"<p>{_sentences(rng, int(rng.integers(3, 60)), odd)}</p>" for _ in range(n))

    def plain(low, high, odd):
        text = _sentences(rng, int(rng.integers(low, high)), odd)
        return text if rng.random() < 0.5 else f"<p>{text}</p>"

    def form():
        return f'<label>{_words(rng, 2, 0.5)}</label><input name="q"><button>{_words(rng, 1, 0.7)}</button>' + (f"<p>{_sentences(rng, 8, 0.4)}</p>" if rng.random() < 0.5 else "")

    def talk():
        each = [f'<div class="comment"><span>{_words(rng, 2)}</span><p>{_sentences(rng, int(rng.integers(3, 40)), 0.05)}</p></div>' if rng.random() < 0.5
                else f"<li><p>{_sentences(rng, int(rng.integers(3, 40)), 0.05)}</p></li>" for _ in range(rng.integers(1, 6))]
        return f"<h3>{_words(rng, 2, 0.6)}</h3>" + "".join(each)

    pick = lambda pool: str(rng.choice(pool))
    maybe = lambda p, make: make() if rng.random() < p else ""
    noise = {
        "ad": lambda: tag(pick(ADS), plain(2, 40, 0.1)), "share": lambda: tag(pick(SHARE), links(int(rng.integers(1, 5))) if rng.random() < 0.6 else plain(2, 12, 0.3)),
        "side": lambda: tag(pick(SIDE), f"<h3>{_words(rng, 3, 0.3)}</h3>" + (links(int(rng.integers(2, 8))) if rng.random() < 0.6 else prose(int(rng.integers(1, 4))))),
        "notice": lambda: tag(pick(NOTICE), plain(4, 30, 0.3) + maybe(0.5, lambda: f"<button>{_words(rng, 1, 0.8)}</button>")), "form": lambda: tag(pick(FORM), form()), "talk": lambda: tag(pick(TALK), talk()),
        "menu": lambda: tag(pick(MENU), links(int(rng.integers(1, 9)))),
    }

    def own(text):
        main.add(" ".join(text.split()))
        return text

    body = []
    if rng.random() < 0.85:
        title = own(_sentences(rng, int(rng.integers(2, 12))).rstrip("."))
        body.append(f"<h1>{title}</h1>")
        if rng.random() < 0.3:
            again = own(_sentences(rng, int(rng.integers(2, 14))))
            body.append(f"<p><b>{again}<br>")
    inside = rng.random() < 0.4
    size = rng.random()
    longest = int(rng.choice([4, 12, 80]))
    repeated = [_sentences(rng, int(rng.integers(1, longest + 1))) for _ in range(3)] if rng.random() < 0.15 else []
    for _ in range(int(rng.integers(0, 3)) if size < 0.15 else int(rng.integers(1, 14)) if size < 0.9 else int(rng.integers(14, 90))):
        kind = rng.random()
        text = own(pick(repeated) if repeated and rng.random() < 0.7 else _sentences(rng, int(rng.integers(1, longest + 1)), 0.03))
        unclosed = rng.random() < 0.2
        if kind < 0.78:
            body.append(f"<p>{text}" + ("" if unclosed else "</p>"))
        elif kind < 0.85:
            body.append(f"<h2>{text}</h2>")
        elif kind < 0.9:
            more = own(_sentences(rng, int(rng.integers(2, 15))))
            body.append(f"<ul><li>{text}</li><li>{more}</li></ul>")
        elif kind < 0.94:
            body.append(f"<blockquote><p>{text}</p></blockquote>")
        elif kind < 0.97:
            body.append(f"<div>{text}</div>")
        else:
            body.append(f"<p>{text}</p><pre>{own(_words(rng, 12))}</pre>")
        if inside and rng.random() < 0.15:
            body.append(noise[pick(["ad", "share", "side", "form", "notice"])]())
    if family == "talk":
        body.append(noise["talk"]())
    elif inside and rng.random() < 0.3:
        body.append(noise[pick(["share", "side", "talk"])]())
    article = tag(pick(MAIN[:2]) if rng.random() < 0.5 else pick(MAIN), "".join(body))
    if rng.random() < 0.3:
        article = tag(pick(("div.container", "div.wrapper", "div#page", "div.row", "main", "section")), article + maybe(0.5, noise["side"]))
    before = maybe(0.5, lambda: tag(pick(HEAD), maybe(0.6, lambda: f"<h2>{_words(rng, 2, 0.2)}</h2>") + plain(1, 8, 0.2) + maybe(0.5, noise["menu"])))
    before += maybe(0.8, noise["menu"]) + maybe(0.3, noise["notice"]) + maybe(0.5, noise["ad"]) + maybe(0.15, noise["form"]) + maybe(0.15, noise["side"])
    after = maybe(0.3, noise["ad"]) + maybe(0.3, noise["talk"]) + maybe(0.4, noise["side"]) + maybe(0.2, noise["form"]) + maybe(0.2, noise["notice"])
    after += maybe(0.85, lambda: tag(pick(FOOT), (f"&copy; {_words(rng, 2)} &middot; " if rng.random() < 0.6 else "") + plain(2, 25, 0.3) + maybe(0.3, lambda: links(3))))
    page = f"<html><head><title>{_words(rng, 4)}</title></head><body>{before}{article}{after}"
    page = page + "</body></html>" if rng.random() < 0.9 else page
    return (_bare(rng, page, family == "cells") if family in ("bare", "cells") else page), main


def accuracy(w: dict, family: str, pages: int = 300, seed: int = 99) -> float:
    """The share of blocks of fresh pages of a family that the network labels right."""
    rng, vectors = np.random.default_rng(seed), Vectors()
    data = [x for x in (labelled(*make_page(rng, family)) for _ in range(pages)) if x[0]]
    got = label([blocks_ for blocks_, _ in data], w, vectors)
    right = [g == np.array(y) for g, (_, y) in zip(got, data, strict=True)]
    return float(np.concatenate(right).mean())


def labelled(page: str, main: set) -> tuple[list, list]:
    found = blocks(page)
    return found, [text in main for text, _, _ in found]
