"""Language-model scores by stupid backoff, computed relationally.

The model is the corpus's own n-gram counts.  A word's score is the relative
frequency of the longest n-gram ending at it that the corpus has at least
``least`` times, times ``BACKOFF`` for every order given up; single words are taken
from the corpus as they are.  A document's score is the sum of the logarithms.

The relation of exploded n-grams (order, hash, block, count) is partitioned by hash,
counted there into the n-gram count table, joined back to the n-grams it came from, and the
words' scores are summed by document.  A row of it carries a run of n-grams, packed in the
order of their hashes, so it never has more rows than n-grams and usually thousands of times
fewer.  A block is documents of about ``BLOCK`` words; its n-grams are combined before they are
sent, so a frequent one counts once for each block and no partition is hotter than another.

Orders go one after another: an n-gram can reach ``least`` only if both n-grams one word
shorter inside it do, so from order three on only those are sent; nothing is lost.  When an
order's counts are written, the tables and shuffles before it go.
"""

from __future__ import annotations

from functools import partial
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import drop, store

BACKOFF = 0.4
ORDER, LEAST = 3, 2
#: Words of a block, and different n-grams that a partition holds, about.
BLOCK, PART = 1_000_000, 1_000_000
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Numbers(dict):
    """Words by first appearance."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _packed(a: np.ndarray) -> bytes:
    """Planes of bytes, compressed: the high bytes of small numbers are almost free."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
    return zstandard.compress(planes.tobytes(), 1)


def _unpacked(raw: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype)[:, 0] if len(planes) else np.empty(0, dtype)


BLOCKS = "block string, rows array<long>, lengths array<long>, ids binary, words binary, counts array<binary>, n long"
_BLOCKS = pa.schema([
    ("block", pa.string()), ("rows", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("ids", pa.binary()), ("words", pa.binary()),
    ("counts", pa.list_(pa.binary())), ("n", pa.int64())])


def _blocks(batches, limit):
    """A block's row ids, lengths, word numbers (frequent words have small ones) and word hashes; n: words."""
    rows, lengths, numbers, known = [], [], [], _Numbers()
    held, serial = 0, count()

    def done():
        words = np.fromiter((xxhash.xxh64_intdigest(w, 7) for w in known), np.uint64, len(known))
        ids = np.concatenate([*numbers, np.empty(0, np.int32)])
        often = np.argsort(-np.bincount(ids, minlength=len(words)), kind="stable")
        number = np.empty(len(words), np.uint32)
        number[often] = np.arange(len(words), dtype=np.uint32)
        name = f"{TaskContext.get().partitionId()}-{next(serial)}"
        return pa.RecordBatch.from_pydict({
            "block": [name], "rows": [rows], "lengths": [lengths], "ids": [_packed(number[ids])], "words": [_packed(words[often])], "counts": [[]], "n": [len(ids)]}, _BLOCKS)

    for batch in batches:
        for row, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()), strict=True):
            found = (text.as_py() or b"").split()
            rows.append(row)
            lengths.append(len(found))
            numbers.append(np.fromiter(map(known.__getitem__, found), np.int32, len(found)))
            held += len(found)
            if held >= limit or len(rows) >= limit:
                yield done()
                rows, lengths, numbers, known, held = [], [], [], _Numbers(), 0
    if rows:
        yield done()


class _Block:
    """A block's words with the counts that are known of the n-grams ending at them, from order 1 on."""

    def __init__(self, row: dict, least: int):
        self.row, self.least = row, least
        self.lengths = np.array(row["lengths"], np.int64)
        self.ids, self.words = _unpacked(row["ids"], np.uint32), _unpacked(row["words"], np.uint64)
        self.hashes = [self.words[self.ids]]
        self.place = np.arange(len(self.ids)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        self.counts = [_unpacked(c, np.uint64) for c in row["counts"]]
        if self.counts:
            self.of_words = self.counts[0]
            self.counts[0] = self.of_words[self.ids]

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of the n-grams of order ``n`` whose counts are asked for."""
        while len(self.hashes) < n:
            size, h = len(self.hashes) + 1, self.hashes[-1]
            longer = np.zeros(len(h), np.uint64)
            x = h[:-1] * _A + self.hashes[0][1:] * _B + np.uint64(size)
            x ^= x >> np.uint64(31)
            x *= _B
            x ^= x >> np.uint64(29)
            longer[1:] = x
            self.hashes.append(longer)
        asked = self.place >= n - 1
        if n > 2:
            often = self.counts[n - 2] >= self.least
            asked[1:] &= often[1:] & often[:-1]
        at = np.flatnonzero(asked)
        return at, self.hashes[n - 1][at]

    def joined(self, n: int, totals: np.ndarray) -> None:
        """Take the totals of the different n-grams of order ``n``, in the order of their hashes."""
        if n == 1:
            self.of_words = totals[np.unique(self.words, return_inverse=True)[1]]
            self.counts.append(self.of_words[self.ids])
            return
        at, h = self.grams(n)
        counts = np.zeros(len(self.place), np.uint64)
        counts[at] = totals[np.unique(h, return_inverse=True)[1]]
        self.counts.append(counts)

    def packed(self) -> list[bytes]:
        """The counts, of order 1 for each word, of the others for each place."""
        return [_packed(c) for c in (self.of_words, *self.counts[1:])]

    def scores(self, words_in_all: int) -> np.ndarray:
        """The logarithm of each word's score."""
        out, order = np.zeros(len(self.place)), len(self.counts)
        open_ = np.ones(len(out), bool)
        for n in range(order, 0, -1):
            c = self.counts[n - 1]
            before = np.full(len(c), words_in_all) if n == 1 else np.r_[np.zeros(min(1, len(c)), np.uint64), self.counts[n - 2][:-1]]
            take = open_ & (c >= (1 if n == 1 else self.least))
            out[take] = np.log10(c[take] / before[take]) + (order - n) * np.log10(BACKOFF)
            open_ &= ~take
        return out


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    """The partition of a hash; sorted hashes have sorted partitions."""
    return ((h >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


GRAMS = "order int, part int, block string, hashes binary, counts binary"


def _exploded(batches, orders, parts, least):
    """Rows (order, part, block, hashes, counts): a block's different n-grams, sorted, cut by partition."""
    for batch in batches:
        for row in batch.to_pylist():
            block = _Block(row, least)
            for n in orders:
                own, counts = np.unique(block.grams(n)[1], return_counts=True)
                cut = np.searchsorted(_part(own, parts), np.arange(parts + 1))
                filled = np.flatnonzero(np.diff(cut))
                gaps = [np.diff(own[cut[p]:cut[p + 1]], prepend=np.uint64(0)) for p in filled]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(filled), n, np.int32)), pa.array(filled.astype(np.int32)), pa.array([row["block"]] * len(filled), pa.string()),
                    pa.array([_packed(g) for g in gaps], pa.binary()),
                    pa.array([_packed(counts[cut[p]:cut[p + 1]].astype(np.uint32)) for p in filled], pa.binary())],
                    ["order", "part", "block", "hashes", "counts"])


def _totals(rows: pd.DataFrame) -> pd.DataFrame:
    """A partition's count table, joined back to each block's n-grams in their order."""
    hashes = [np.cumsum(_unpacked(x, np.uint64), dtype=np.uint64) for x in rows.hashes]
    counts = np.concatenate([_unpacked(x, np.uint32) for x in rows.counts]).astype(np.int64)
    ends = np.cumsum([len(x) for x in hashes])
    _, which = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(which, weights=counts).astype(np.uint64)[which]
    return pd.DataFrame({"order": rows.order, "part": rows.part, "block": rows.block, "totals": [_packed(x) for x in np.split(total, ends[:-1])]})


def _known(batches, orders, least):
    """Blocks with the counts that have come back for their n-grams."""
    for batch in batches:
        for row in batch.to_pylist():
            block = _Block(row, least)
            back = sorted(((t["order"], t["part"], t["totals"]) for t in row["totals"] or ()), key=lambda t: t[:2])
            for n in orders:
                block.joined(n, np.concatenate([np.empty(0, np.uint64), *[_unpacked(t[2], np.uint64) for t in back if t[0] == n]]))
            yield block, max(orders)


def _level(batches, orders, least):
    """Blocks with their counts; n: n-grams of the next order that will be asked for."""
    for block, n in _known(batches, orders, least):
        row = block.row | {"counts": block.packed(), "n": len(block.grams(n + 1)[0])}
        yield pa.RecordBatch.from_pydict({f.name: [row[f.name]] for f in _BLOCKS}, _BLOCKS)


def _scored(batches, orders, least, words_in_all):
    for block, _ in _known(batches, orders, least):
        of = np.repeat(np.arange(len(block.lengths)), block.lengths)
        sums = np.bincount(of, weights=block.scores(words_in_all), minlength=len(block.lengths)).astype(float)
        yield pa.RecordBatch.from_arrays([pa.array(block.row["rows"], pa.int64()), pa.array(block.lengths), pa.array(sums)], ["doc_id", "n_words", "log10_score"])


def score(docs: DataFrame, order: int = ORDER, least: int = LEAST, block: int = BLOCK, part: int = PART) -> DataFrame:
    """doc_id, n_words, log10_score and mean_log10 of every row of ``docs``, under the corpus's own model.

    The first words of a document have shorter histories and back off for the rest.  Documents
    without words score 0 and have a null mean; null doc_ids and repeated rows stay and
    count; an empty table gives an empty result.  Counts are of all words of all rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    blocks = store(rows.mapInArrow(partial(_blocks, limit=block), BLOCKS), "blocks")
    words = asked = blocks.agg(F.sum("n")).first()[0] or 0

    def totals(rows: pd.DataFrame) -> pd.DataFrame:
        return _totals(rows)

    steps = [[n for n in (1, 2) if n <= order], *[[n] for n in range(3, order + 1)]]
    for orders in steps:
        grams = blocks.mapInArrow(partial(_exploded, orders=orders, parts=max(1, -(-asked // part)), least=least), GRAMS)
        counted = grams.groupBy("order", "part").applyInPandas(totals, "order int, part int, block string, totals binary")
        # As much as the block has different n-grams, at about a byte each.
        back = store(counted.groupBy("block").agg(F.collect_list(F.struct("order", "part", "totals")).alias("totals")), "totals")
        del grams, counted
        drop(spark)
        ready = blocks.join(back, "block", "left").select(*blocks.columns, "totals")
        if orders is not steps[-1]:
            after = store(ready.mapInArrow(partial(_level, orders=orders, least=least), BLOCKS), "counted")
            asked = after.agg(F.sum("n")).first()[0] or 0
            del ready
            drop(spark, blocks, back)
            blocks = after
    out = ready.mapInArrow(partial(_scored, orders=orders, least=least, words_in_all=words), "doc_id long, n_words long, log10_score double")
    return out.select("doc_id", "n_words", "log10_score", (F.col("log10_score") / F.when(F.col("n_words") > 0, F.col("n_words"))).alias("mean_log10"))


def sql(least: int = LEAST) -> str:
    """The default query (order 3) as DuckDB SQL."""
    return f"""
with w as (
  select doc_id, unnest(l) as w, generate_subscripts(l, 1) as i
  from (select doc_id, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as l from documents)),
grams as (select doc_id, i, w, lag(w) over h as p, lag(w, 2) over h as q from w window h as (partition by doc_id order by i)),
c1 as (select w, count(*) as n from w group by 1),
c2 as (select p, w, count(*) as n from grams where p is not null group by 1, 2),
c3 as (select q, p, w, count(*) as n from grams where q is not null group by 1, 2, 3),
s as (
  select doc_id, case when c3.n >= {least} then log10(c3.n / h2.n) when c2.n >= {least} then log10(c2.n / h1.n) + log10({BACKOFF})
    else log10(c1.n / (select count(*) from w)) + 2 * log10({BACKOFF}) end as s
  from grams g join c1 on c1.w = g.w left join c2 on c2.p = g.p and c2.w = g.w left join c1 h1 on h1.w = g.p
  left join c3 on c3.q = g.q and c3.p = g.p and c3.w = g.w left join c2 h2 on h2.p = g.q and h2.w = g.p)
select d.doc_id, coalesce(n, 0)::bigint as n_words, round(coalesce(t, 0), 4) as log10_score, round(t / n, 4) as mean_log10
from documents d left join (select doc_id, count(*) as n, sum(s) as t from s group by 1) using (doc_id)"""
