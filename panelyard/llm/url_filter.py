"""URL filters: host and path rules, and exact domain lists by a cascade of Bloom filters.

The cascade knows the corpus's complete key universe (all different hosts).
Level 0 encodes the listed keys; level 1 the unlisted keys that level 0 lets
through by mistake; level 2 the listed keys that level 1 lets through, and so on
until no mistakes are left.  A key is then listed or not according to the first
level that stops it, exactly, and pages are judged by expressions over the
filters' words without any join.  Filters are built by aggregation over the
universe; their size follows from the number of listed keys.

What a task holds of a cascade is bounded by ``max_bytes``: where the listed keys need more,
hosts are dealt into as many parts as that takes by a hash, each part has a cascade of its
own, and pages pass them one after another.
"""

from __future__ import annotations

import math
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import store

#: (verdict, host, path start)
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
#: Domains listed by default.
LIST = Path(__file__).with_name("lists") / "blocked_domains.txt"
#: Most bytes of a cascade, about.
MAX_BYTES = 8 << 20
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def domains(path: Path = LIST) -> list[str]:
    """The lines of a list, without blank ones and comments."""
    lines = (x.strip() for x in path.read_text().splitlines())
    return [x for x in lines if x and not x.startswith("#")]


def host(url: Column) -> Column:
    """The host after the first ``://``, A-Z lower-cased; empty for null or without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _UPPER.lower())


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def match(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null; of equal length, the one given first."""
    out = None
    for verdict, name, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        hit = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return out


class Cascade:
    """Levels of Bloom filters over a universe of keys; ``listed(key)`` is an exact test for its keys."""

    def __init__(self, universe: DataFrame):
        """``universe``: different keys ``key`` (string) with ``listed`` (boolean)."""
        self.levels: list[tuple[DataFrame, int, int]] = []
        ours, others = universe.filter("listed").select("key"), universe.filter("not listed").select("key")
        n_ours, n_others = ours.count(), others.count()
        while n_ours:
            hashes, words = self.shape(n_ours, n_others if not self.levels else 0)
            self.levels.append((store(self._words(ours, len(self.levels), hashes, words), "level"), hashes, words))
            wrong = store(others.filter(self._holds(F.col("key"), len(self.levels) - 1)), "wrong")
            ours, others = wrong, ours
            n_ours, n_others = wrong.count(), n_ours

    @staticmethod
    def shape(n_ours: int, n_others: int) -> tuple[int, int]:
        """(hash functions, words) of a level; without a number of others it lets half of them through."""
        wanted = n_ours / (math.sqrt(2) * n_others) if n_others else 0.5
        hashes = max(1, round(-math.log2(min(0.5, wanted))))
        return hashes, max(1, math.ceil(n_ours * hashes / math.log(2) / 64))

    @staticmethod
    def _bits(key: Column, level: int, hashes: int, words: int) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(64 * words)) for j in range(hashes)]

    def _words(self, keys: DataFrame, level: int, hashes: int, words: int) -> DataFrame:
        """The level as one row with an array of ``words`` longs."""
        bit = keys.select(F.explode(F.array(*self._bits(F.col("key"), level, hashes, words))).alias("bit"))
        some = bit.groupBy((F.col("bit") / 64).cast("int").alias("at")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("word"))
        all_ = keys.sparkSession.range(words).select(F.col("id").cast("int").alias("at")).join(some, "at", "left")
        return all_.agg(F.transform(F.sort_array(F.collect_list(F.struct("at", F.coalesce("word", F.lit(0).cast("long")).alias("word")))), lambda x: x["word"]).alias("words"))

    def _holds(self, key: Column, level: int) -> Column:
        table, hashes, words = self.levels[level]
        filled = table.select("words").scalar()
        tests = [F.getbit(F.get(filled, (b / 64).cast("int")), b % 64) == 1 for b in self._bits(key, level, hashes, words)]
        return reduce(Column.__and__, tests)

    def listed(self, key: Column) -> Column:
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            out = F.when(self._holds(key, level), out).otherwise(F.lit(level % 2 == 1))
        return out


def _universe(pages: DataFrame, listed: DataFrame) -> DataFrame:
    """(key, listed): all different hosts, and whether the host or a domain it lies in is in ``listed`` (key)."""
    hosts = store(pages.select(host(F.col("url").cast("string")).alias("key")).distinct(), "hosts")
    labels = F.split("key", r"\.")
    inside = hosts.select("key", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))).alias("domain"))
    wanted = listed.select(F.col("key").cast("string").alias("domain")).filter("domain is not null").distinct()
    named = inside.join(wanted, "domain", "left_semi").select("key").distinct().withColumn("listed", F.lit(True))
    return store(hosts.join(named, "key", "left").select("key", F.coalesce("listed", F.lit(False)).alias("listed")), "universe")


def judge(pages: DataFrame, listed: DataFrame | None = None, rules=RULES, max_bytes: int = MAX_BYTES) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages``.

    The verdict is the longest fitting rule's; without one it is ``block`` if the host or a
    domain it lies in is listed, else ``allow``.  ``listed`` has domains in ``key`` (null and repeated
    ones are ignored); by default those of LIST.  Null urls and such without ``://`` have empty host and
    path and are allowed unless the empty host is listed.  Repeated rows stay; an empty table gives an empty result.
    """
    if listed is None:
        listed = pages.sparkSession.range(1).select(F.explode(F.array(*[F.lit(x) for x in domains()])).alias("key"))
    universe = _universe(pages, listed)
    n, ours = universe.agg(F.count("*"), F.count_if("listed")).first()
    # The levels after the first are less than twice as many bits as there are listed keys.
    bits = 64 * Cascade.shape(max(1, ours), n - ours)[1] + 2 * ours
    parts = max(1, math.ceil(bits / 8 / max_bytes))
    url = F.col("url").cast("string")
    rule = match(F.col("host"), F.col("path"), rules)

    def judged(part: int) -> DataFrame:
        own = lambda df, key: df.filter(F.pmod(F.xxhash64(F.col(key), F.lit(parts)), F.lit(parts)) == part) if parts > 1 else df
        rows = own(pages.select("page_id", host(url).alias("host"), path(url).alias("path")), "host")
        rows = rows.withColumn("_listed", Cascade(own(universe, "key")).listed(F.col("host"))).withColumn("_rule", rule)
        verdict = F.coalesce(F.col("_rule.verdict"), F.when(F.col("_listed"), "block").otherwise("allow"))
        out = rows.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), verdict.alias("verdict"))
        return store(out, "judged") if parts > 1 else out

    return reduce(DataFrame.union, [judged(part) for part in range(parts)])


def sql(rules=RULES) -> str:
    """The default query as DuckDB SQL."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [f"(host = '{h}' or host like '%.{h}') and starts_with(path, '{p}')" for _, h, p in ordered]
    rule = " ".join(f"when {f} then '{h}{p}'" for f, (_, h, p) in zip(fits, ordered, strict=True))
    verdict = " ".join(f"when {f} then '{v}'" for f, (v, _, _) in zip(fits, ordered, strict=True))
    names = ", ".join(f"('{x}')" for x in domains())
    return f"""
with parts as (
  select page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{_UPPER}', '{_UPPER.lower()}') as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) as path
  from pages),
listed as (select distinct host from parts, (values {names}) as l(d) where host = d or ends_with(host, '.' || d))
select page_id, host, path, case {rule} end as rule,
  case {verdict} when host in (select host from listed) then 'block' else 'allow' end as verdict
from parts"""
