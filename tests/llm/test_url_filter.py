import random
import re

import pytest
from pyspark.sql import functions as F

from panelyard.llm import url_filter as U


BAD = [f"{name}.example.{top}" for name in ("spam-farm", "cheap-pills", "casino-win", "free-bets", "ads-track", "adult-x") for top in ("com", "net", "org")]


def slow(url, listed=BAD):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), v, h + p) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[1] if best else "block" if any(host == d or host.endswith("." + d) for d in listed) else "allow"


ODD = [
    None, "", "no scheme", "http://", "https://ORG/", "http://org", "http://a.ORG/x?y#z", "http://xorg/", "ftp://Example.org/es/1", "http://www.example.org/en/1",
    "http://example.org/en/2", "x://y://org/a", "http://example.com/fr/", "http://example.com/de/x?://org/", "http://m.spam-farm.example.net/en", "http://com/de/#a",
    "HTTP://WWW.CHEAP-PILLS.EXAMPLE.COM/en/ä", "://org/x", "http://ÄB.org/É", "http://a.org\n/x\ny?z", "http://spam-farm.example.net", "http://example.com?/fr/", "http://example.com#/fr/",
]


def check(pages, **options):
    want = sorted(((r.page_id, *slow(r.url, **({"listed": options["names"]} if "names" in options else {}))) for r in pages.select("page_id", "url").collect()), key=str)
    options.pop("names", None)
    got = U.judge(pages, **options).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got), key=str) == want


def test_table(spark, sf):
    check(spark.read.parquet(f"{sf}/pages.parquet"))


def test_odd(spark):
    rows = [(i if i % 5 else None, u, "x", "y") for i, u in enumerate(ODD + ODD[:4])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, listed string")
    check(pages)
    check(pages.filter("false"))
    check(pages, max_bytes=1)


@pytest.mark.parametrize("share", [0.01, 0.3, 0.9, 1.0])
def test_cascade_is_exact(spark, share):
    rng = random.Random(7)
    rows = [(f"h{i}.net", rng.random() < share) for i in range(3000)]
    universe = spark.createDataFrame(rows, "key string, listed boolean")
    cascade = U.Cascade(universe)
    got = {r.key: r.got for r in universe.withColumn("got", cascade.listed(F.col("key"))).collect()}
    assert got == dict(rows)
    plan = universe.withColumn("got", cascade.listed(F.col("key")))._jdf.queryExecution().toString()
    assert "Join" not in plan


def test_lists(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    names = {slow(r.url)[0] for r in pages.collect()}
    some = sorted(names)[::3]
    listed = spark.createDataFrame([(n,) for n in [*some, some[0], None, "unknown.net"]], "key string")
    check(pages, listed=listed, names=set(some))
    check(pages, listed=listed, names=set(some), max_bytes=1)
    check(pages, listed=listed.filter("false"), names=set())


def test_large_lists_pass_in_parts(spark):
    hosts = [f"h{i}.net" for i in range(500)]
    pages = spark.createDataFrame([(i, f"http://{h}/x") for i, h in enumerate(hosts * 2)], "page_id long, url string")
    listed = spark.createDataFrame([(h,) for h in hosts[::2]], "key string")
    got = U.judge(pages, listed, max_bytes=64)
    assert {(r.host, r.verdict) for r in got.collect()} == {(h, "allow" if i % 2 else "block") for i, h in enumerate(hosts)} and got.count() == 1000
    assert "Join" not in got._jdf.queryExecution().toString()


def test_every_bad_name_is_listed(spark):
    hosts = ["m.casino-win.example.com", "free-bets.example.com", "m.ads-track.example.com", "blog.adult-x.example.net", "www.spam-farm.example.com", "a.b.cheap-pills.example.com"]
    pages = spark.createDataFrame([(i, f"http://{h}/x") for i, h in enumerate([*hosts, "ththti.example.net", "notspam-farm.example.net"])], "page_id long, url string")
    got = {r.host: (r.rule, r.verdict) for r in U.judge(pages).filter("rule is null").collect()}
    assert got == {h: (None, "block") for h in hosts if not h.endswith(".org")} | {h: (None, "allow") for h in ("ththti.example.net", "notspam-farm.example.net")}
