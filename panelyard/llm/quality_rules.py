"""Quality rules whose cutoffs are chosen under a guarantee on false rejection.

Every document gets counts; rates of them are the rules' scores.  For each
stratum one sequence of rule sets, all rules at their first and loosest cutoffs, then all at
their second and so on, is tested on the labelled documents: the number of good ones that
a set rejects is held against the exact binomial tail for the allowed rate.  The first
set that fails ends the sequence (fixed-sequence testing, which needs no correction along it), and
the error level is divided by the number of strata that could pass at all: the least p-value a
stratum can have follows from its number of labels alone, and one that is above its share of the
error level needs none (Tarone's correction).  So with probability 1 - ``error`` the rules
reject no more than ``allowed`` of the good documents of any stratum.  At the default rates
that takes 149 good labelled documents if only one stratum has as many, 217 if four do; a
stratum with too few keeps everything but what the base rules reject.

DataFrame functions only; a text is read once and nothing but counts is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import NOT_SPACE, SPACE, let, store, unused, words

SYMBOLS = "#*$%&|<>"
#: Rule: (score as SQL over the counts, cutoffs from loose to strict). A score above the cutoff rejects.
RULES = {
    "symbols": ("n_symbols / n_words", (2.0, 1.0, 0.5, 0.3, 0.2, 0.1)),
    "shouts": ("n_shouts / n_words", (1.5, 1.0, 0.7, 0.5, 0.3)),
    "repeats": ("n_repeat_words / n_words", (0.48, 0.44, 0.4, 0.36, 0.32)),
    "long_words": ("word_chars / n_words", (12.0, 10.0, 9.0, 8.0, 7.5)),
    "same_lines": ("n_dup_lines / n_lines", (0.9, 0.8, 0.7, 0.6, 0.5)),
}
ALLOWED, ERROR = 0.02, 0.05


def _length_without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return F.length(text)


def repeat_words(found: Column) -> Column:
    """How many words lie in three-word windows that the text has twice or more.

    Windows are sorted by hash with their places; equal neighbours mark both places, and
    the marked places, in order, cover up to three new words each.
    """
    def windows(w):
        hashed = F.transform(F.slice(w, 1, F.size(w) - 2), lambda a, i: F.struct(
            F.xxhash64(a, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
        return let(F.sort_array(hashed), places)

    def places(s):
        pairs = F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1), lambda a, b: F.when(
            a["h"] == b["h"], F.array(a["i"], b["i"])))
        marked = F.sort_array(F.flatten(F.filter(pairs, lambda p: p.isNotNull())))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(marked, start, lambda acc, i: F.struct(
            i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")), lambda acc: acc["n"])

    return F.when(F.size(found) >= 4, let(found, windows)).otherwise(F.lit(0).cast("long"))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_shouts", "n_lines"]


def counts(docs: DataFrame, keep: list = ()) -> DataFrame:
    """The counts of every row's whole text (null: no words), after doc_id, stratum and ``keep``."""

    def line_counts(lines):
        return F.struct(F.size(lines).alias("n"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("dup"))

    by_word = let(words(F.col("_text")), lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("again")))
    by_line = let(F.filter(F.split("_text", "\n"), lambda x: x.rlike(NOT_SPACE)), line_counts)
    found = {
        "n_words": F.col("_w.n"), "n_repeat_words": F.col("_w.again"), "n_lines": F.col("_l.n"), "n_dup_lines": F.col("_l.dup"),
        "word_chars": F.length(F.regexp_replace("_text", SPACE, "")),
        "n_symbols": F.length("_text") - _length_without(F.col("_text"), SYMBOLS),
        "n_shouts": F.length("_text") - _length_without(F.col("_text"), "!"),
    }
    held = docs.select("doc_id", "stratum", *keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    held = held.select("*", by_word.alias("_w"), by_line.alias("_l"))
    return held.select("doc_id", "stratum", *keep, *[found[c].cast("long").alias(c) for c in COUNTS])


def _tail(n: Column, k: Column, rate: float) -> Column:
    """P(X <= k) for X binomial of n and rate, exactly, summed in logarithms; 1 where k is no fewer than expected."""
    first = n * F.log1p(F.lit(-rate))

    def add(acc, j):
        term = acc["term"] + F.log((n - j + 1) / j) + F.log(F.lit(rate / (1 - rate)))
        return F.struct(term.alias("term"), (F.greatest(acc["sum"], term) + F.log1p(F.exp(-F.abs(acc["sum"] - term)))).alias("sum"))

    sums = F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1))), F.struct(first.alias("term"), first.alias("sum")), add, lambda acc: acc["sum"])
    return F.when(k >= n * rate, 1.0).when(k == 0, F.exp(first)).otherwise(F.exp(sums))


def rule_sets(rules: dict = RULES) -> list[dict]:
    """The sequence of rule sets, each with a cutoff for every rule; rules with fewer cutoffs stay at their last."""
    return [{rule: cuts[min(i, len(cuts) - 1)] for rule, (_, cuts) in rules.items()} for i in range(max(len(cuts) for _, cuts in rules.values()))]


def _rejects(own: dict, rules: dict) -> str:
    return " or ".join(f"{rules[rule][0]} > {cut}" for rule, cut in own.items())


def cutoffs(counted: DataFrame, labels: DataFrame, allowed: float = ALLOWED, error: float = ERROR, rules: dict = RULES) -> DataFrame:
    """(stratum, a column for each rule): the strictest cutoffs under the guarantee, null where none holds."""
    good = labels.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min("quality").alias("_q")).filter("_q = 1")
    held = counted.filter("not base_failed").join(good, F.col("doc_id") == F.col("_id"), "left_semi")
    sets = rule_sets(rules)
    wide = held.groupBy("stratum").agg(F.count("*").alias("n"), *[F.count_if(F.expr(_rejects(own, rules))).alias(f"_{i}") for i, own in enumerate(sets)])
    # One row for each stratum.
    least = F.sort_array(F.collect_list(F.pow(F.lit(1 - allowed), F.col("n"))).over(Window.partitionBy()))
    strata = F.array_min(F.filter(F.sequence(F.lit(1), F.size("_least")), lambda m: F.coalesce(F.get("_least", m) > F.lit(error) / m, F.lit(True))))
    tests = wide.withColumn("_least", least).withColumn("_strata", strata)
    holds, by = F.lit(True), {rule: F.lit(None).cast("double") for rule in rules}
    for i, own in enumerate(sets):
        holds = holds & (_tail(F.col("n"), F.col(f"_{i}"), allowed) <= F.lit(error) / F.col("_strata"))
        by = {rule: F.when(holds, F.lit(cut)).otherwise(by[rule]) for rule, cut in own.items()}
    return tests.select("stratum", *[c.alias(f"cut_{rule}") for rule, c in by.items()])


def row_key(stratum: str = "lang") -> Column:
    """A hash of all that the verdict looks at."""
    return F.xxhash64(F.col("text").cast("string"), F.col(stratum).cast("string")).alias("row_key")


def kept(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, as they are.  Texts move once, next to the keys of rejected rows."""
    id_, key = unused(docs, "_id", "_key")
    gone = store(judge(docs, labels, stratum, keep=True, **options).filter("not kept").select(
        F.col("doc_id").alias(id_), F.col("row_key").alias(key)).distinct(), "rejected")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (row_key(stratum) == F.col(key))
    return docs.join(gone.hint("shuffle_hash"), same, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", least: int = 50, repeats: int = 50, keep: bool = False,
          allowed: float = ALLOWED, error: float = ERROR, rules: dict = RULES) -> DataFrame:
    """doc_id, the counts, base_failed, rejected_by and kept for every row of ``docs``; with ``keep`` also ``row_key``.

    base_failed: fewer than ``least`` words, or more than ``repeats`` per cent of them in
    repeated windows.  rejected_by names the first rule above its cutoff, ``base``, or is null.  A null
    stratum is one of its own; null or empty texts fail the base; repeated rows stay; labels
    of unknown documents are ignored, and a document is good if all its labels say 1.
    row_key: see ``row_key``; rows that share it and the doc_id have one verdict.
    """
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), "text", *([row_key(stratum)] if keep else []))
    failed = (F.col("n_words") < least) | (F.col("n_repeat_words") * 100 > F.col("n_words") * repeats)
    counted = store(counts(held, ["row_key"] if keep else []).withColumn("base_failed", failed), "counts")
    found = store(cutoffs(counted, labels, allowed, error, rules), "cutoffs")
    judged = counted.join(found.withColumnRenamed("stratum", "_stratum"), F.col("stratum") == F.col("_stratum"), "left")
    by = F.when(F.col("base_failed"), "base")
    for rule, (score, _) in rules.items():
        by = by.when(F.expr(score) > F.col(f"cut_{rule}"), rule)
    out = judged.withColumn("rejected_by", by).withColumn("kept", F.col("rejected_by").isNull())
    return out.select("doc_id", *COUNTS, "base_failed", "rejected_by", "kept", *(["row_key"] if keep else []))


def sql(allowed: float = ALLOWED, error: float = ERROR, rules: dict = RULES) -> str:
    """The default query as DuckDB SQL; the binomial tail is summed from log-gamma terms."""
    sets = rule_sets(rules)
    tests = " union all ".join(f"select stratum, {i} as i, count(*) as n, count_if({_rejects(own, rules)})::bigint as k from held group by stratum" for i, own in enumerate(sets))
    cuts = " union all ".join(f"select {i} as i, '{rule}' as rule, {cut}::double as cut" for i, own in enumerate(sets) for rule, cut in own.items())
    by = " ".join(f"when {score} > (select min(cut) from chosen x where x.stratum = c.stratum and x.rule = '{rule}') then '{rule}'" for rule, (score, _) in rules.items())
    return f"""
with d as (
  select doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as l,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from documents),
places as (select doc_id, unnest(generate_series(1, len(l) - 2)) as i from d where len(l) >= 3),
windows as (select p.doc_id, p.i, d.l[p.i:p.i + 2] as w from places p join d using (doc_id)),
often as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, w) as n from windows) where n > 1),
again as (select doc_id, count(distinct i + j) as n from often, (values (0), (1), (2)) as s(j) group by 1),
counted as (
  select d.doc_id, stratum, len(l)::bigint as n_words, len(array_to_string(l, ''))::bigint as word_chars,
    len(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(again.n, 0)::bigint as n_repeat_words, len(regexp_replace(t, '[^!]', '', 'g'))::bigint as n_shouts, len(lines)::bigint as n_lines
  from d left join again using (doc_id)),
c as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counted),
held as (select * from c where not base_failed and doc_id in (select doc_id from labels group by 1 having min(quality) = 1)),
sizes as (select stratum, count(*) as n from held group by 1),
tests as ({tests}),
tails as (
  select *, case when k >= n * {allowed} then 1 else (
    select sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({allowed}) + (n - j) * ln(1 - {allowed}))) from (select unnest(generate_series(0, k)) as j)) end as p,
    (select min(m) from range(1, 1 + (select count(*) from sizes)) r(m) where (select count(*) from sizes where pow({1 - allowed}, n) <= {error} / m) <= m) as strata from tests),
chain as (select *, min((p <= {error} / strata)::int) over (partition by stratum order by i) as holds from tails),
last as (select stratum, max(i) as i from chain where holds = 1 group by 1),
chosen as (select stratum, rule, cut from last join ({cuts}) using (i))
select *, rejected_by is null as kept from (
  select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_shouts, n_lines, base_failed,
    case when base_failed then 'base' {by} end as rejected_by from c)"""
