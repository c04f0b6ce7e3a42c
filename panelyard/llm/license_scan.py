"""Licence scans: windows of normalised text against licence templates, by Dice's coefficient over word bigrams.

A text is normalised as a whole (letters and digits, lower-cased; line ends are spaces), so notices
wrapped over lines, standing inside a sentence, and whole licence texts are all runs of its words.  Of a
template of n words the windows are the runs of n words, or fewer at the text's end, that begin
with one of its bigrams.  A window's distinct bigrams A and the template's B score
2 |A and B| / (|A| + |B|).

A score of t takes at least t / (2 - t) of the template's bigrams, which bounds sizes: templates with more
than the text's are not tried, nor those of which the text has fewer.  The same bound says that of
any larger rest of the bigrams one must be in the text; words are chosen, long ones first, that are in
such a rest for every template, and texts with none of them are passed over unsplit.  All of
that is exact.  DataFrame functions only, no shuffle.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import let

LIST = Path(__file__).with_name("lists") / "licenses.txt"
THRESHOLD = 0.8


def templates(path: Path = LIST) -> list[tuple[str, str]]:
    """(licence, text) of a list; lines that start with # are comments."""
    out: list[tuple[str, list[str]]] = []
    for line in path.read_text().splitlines():
        if line.startswith("== "):
            out.append((line[3:].strip(), []))
        elif out and not line.startswith("#"):
            out[-1][1].append(line)
    return [(name, "\n".join(lines)) for name, lines in out]


def _normal(text: str) -> list[str]:
    return re.sub(r"[^\w]|_", " ", text.lower()).split()


class _Template:
    def __init__(self, name: str, text: str, threshold: float):
        words = _normal(text)
        self.name, self.words = name, len(words)
        self.grams = list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))
        self.need = math.ceil(threshold / (2 - threshold) * len(self.grams) - 1e-9)


def _marks(own: list[_Template]) -> list[str]:
    """Words of which any text that matches has one: for every template they are in more bigrams than a match can do without."""
    marks: list[str] = []
    for t in own:
        def bare():
            return sum(not set(g.split()) & set(marks) for g in t.grams)

        for word in sorted({w for g in t.grams for w in g.split()}, key=lambda w: (-len(w), w)):
            if bare() < t.need:
                break
            if word not in marks and any(word in g.split() and not set(g.split()) & set(marks) for g in t.grams):
                marks.append(word)
    return sorted(marks)


def scan(docs: DataFrame, given: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_matches, license, score and word of every row of ``docs``.

    n_matches: templates of which a window reaches ``threshold``.  license, score and word (its first,
    from 1): the best window; ties go to the first word, then to the template given first.  All
    null without a match, as for null, empty or one-word texts.  Repeated rows stay; an empty table gives an
    empty result.  Templates of fewer than two words match nothing.
    """
    own = [t for t in (_Template(*x, threshold) for x in given or templates()) if t.grams]
    flat = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.col("text").cast("string")), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    some = reduce(Column.__or__, [F.contains("_flat", F.lit(f" {w} ")) for w in _marks(own)], F.lit(False))
    all_ = F.array(*[F.struct(
        F.lit(i).alias("at"), F.lit(t.words).alias("words"), F.lit(t.need).alias("need"), F.array(*[F.lit(g) for g in t.grams]).alias("grams")) for i, t in enumerate(own)])

    def best(b, t):
        """The best window of template ``t`` among the bigrams ``b``, or null."""
        hits = F.filter(F.transform(b, lambda x, i: F.struct(i.alias("i"), F.array_position(t["grams"], x).alias("g"))), lambda h: h["g"] > 0)

        def scored(hs, h, k):
            inside = F.filter(F.slice(hs, k + 1, t["words"] - 1), lambda q: q["i"] < h["i"] + t["words"] - 1)
            score = lambda x: F.lit(2.0) * x / (F.size(F.array_distinct(F.slice(b, h["i"] + 1, t["words"] - 1))) + F.size(t["grams"]))
            same = F.size(F.array_distinct(F.transform(inside, lambda q: q["g"])))
            return let(same, lambda x: F.when(x >= t["need"], F.struct(score(x).alias("score"), (-h["i"]).alias("first"), (-t["at"]).alias("at"))))

        return let(hits, lambda hs: F.array_max(F.transform(hs, lambda h, k: scored(hs, h, k))))

    def matches(w):
        bigrams = F.when(F.size(w) >= 2, F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, c: F.concat_ws(" ", a, c)))
        fits = lambda b, t: (F.size(b) >= t["need"]) & (F.size(F.array_intersect(b, t["grams"])) >= t["need"])
        return let(bigrams, lambda b: F.filter(F.transform(all_, lambda t: F.when(fits(b, t), best(b, t))), lambda m: m["score"] >= threshold))

    words = F.filter(F.split("_flat", " "), lambda x: x != "")
    name = F.element_at(F.array(*[F.lit(t.name) for t in own]), (1 - F.col("_best.at")).cast("int"))
    return (
        docs.select("doc_id", flat.alias("_flat"))
        .select("doc_id", F.when(some, let(words, matches)).alias("_hits"))
        .select("doc_id", F.greatest(F.coalesce(F.size("_hits"), F.lit(0)), F.lit(0)).cast("long").alias("n_matches"), F.array_max("_hits").alias("_best"))
        .select("doc_id", "n_matches", F.when(F.col("_best").isNotNull(), name).alias("license"), F.col("_best.score").alias("score"), (1 - F.col("_best.first")).cast("int").alias("word")))


def sql(given: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> str:
    """The default query as DuckDB SQL, over all windows of every text, without any pruning."""
    own = [_Template(*x, threshold) for x in given or templates()]
    rows = ", ".join(f"({i}, '{t.name}', {t.words}, [{', '.join(repr(g) for g in t.grams)}])" for i, t in enumerate(own))
    return f"""
with templates(pos, license, words, b) as (values {rows}),
split as (select doc_id, list_filter(string_split(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> '') as w from documents),
texts as (select doc_id, list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]) as g from split where len(w) >= 2),
grams as (select doc_id, unnest(g) as x, generate_subscripts(g, 1) as i from texts),
hits as (select doc_id, pos, i, x from grams join (select pos, unnest(b) as x from templates) using (x)),
windows as (
  select s.doc_id, s.pos, s.i, count(distinct h.x) as n from (select distinct doc_id, pos, i from hits) s
  join hits h on h.doc_id = s.doc_id and h.pos = s.pos join templates t on t.pos = s.pos where h.i >= s.i and h.i < s.i + words - 1 group by all),
scored as (
  select v.doc_id, v.pos, v.i, license, 2.0::double * n / (len(list_distinct(g[v.i:v.i + words - 2])) + len(b)) as score
  from windows v join templates t on t.pos = v.pos join texts d on d.doc_id = v.doc_id),
best as (select *, row_number() over (partition by doc_id order by score desc, i, pos) as r from scored where score >= {threshold})
select d.doc_id, coalesce(n, 0)::bigint as n_matches, license, score, i::int as word
from documents d left join (select doc_id, count(distinct pos) as n from best group by 1) using (doc_id)
left join best on best.doc_id = d.doc_id and r = 1"""
