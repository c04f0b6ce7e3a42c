"""Substring dedup by level-wise doubling.

A window is a run of consecutive words of one document.  The first level looks
at windows of half the wanted length; those that repeat there are extended to twice
that, the wanted length, and windows that repeat at any length are extended to twice it where the
window that follows repeats too, until no candidates survive.  What repeats at the wanted length
is removed (longer repeats lie inside it); the last length says how long a document's repeats get.

Window hashes double as well: the hash of 2k words mixes two hashes of k words.
On the first level a document sends, for each window of the next level, only the
smallest of the first-level hashes inside it (equal windows have equal smallest
hashes, so nothing is lost), which is about one hash in thirteen.  Texts that
repeat as a whole meet before, by their digest; only the one with the smallest
doc_id goes on.  Tables and shuffles of a finished level go.  What repeats is decided by counting with map-side combining and
by joins; no group of copies is gathered in one task.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import drop, store

#: Words kept in a worker's cache of word hashes.
CACHE = 200_000
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(29)


class _Words:
    """Word hashes of whole texts; ``seed`` separates independent hash families."""

    def __init__(self, seed: int):
        self.seed, self.known = seed, {}

    def __call__(self, found: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > CACHE:
            known.clear()
        for w in set(found).difference(known):
            known[w] = xxhash.xxh64_intdigest(w, self.seed)
        return np.fromiter(map(known.__getitem__, found), np.uint64, len(found))


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _A + (b ^ (b >> _C)) * _B
    x ^= x >> np.uint64(32)
    x *= _A
    return x ^ (x >> _C)


def window_hashes(word_hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of ``length`` words, by doubling."""
    n = len(word_hashes)
    if n < length:
        return np.empty(0, np.uint64)
    power, size, out, done = word_hashes, 1, None, 0
    while True:
        if length & size:
            m = n - done - size + 1
            out = power if out is None else _mix(out[:m], power[done:done + m])
            done += size
        if done == length:
            return out
        m = len(power) - size
        power, size = _mix(power[:m], power[size:size + m]), size * 2


def _smallest(h: np.ndarray, span: int) -> np.ndarray:
    """The smallest of each ``span`` neighbours."""
    size = 1
    while size * 2 <= span:
        h, size = np.minimum(h[:-size], h[size:]), size * 2
    rest = span - size
    return np.minimum(h[:-rest], h[rest:]) if rest else h


def _halves(found: list[bytes], words: _Words, length: int) -> np.ndarray:
    """For each window its smallest half-length hash; empty if the text is shorter."""
    if len(found) < length:
        return np.empty(0, np.uint64)
    half = length // 2
    return _smallest(window_hashes(words(found), half), length - half + 1)


def _lists(arrays) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64) if flat.dtype == np.uint64 else flat))


def _texts(batch, at):
    return (t.as_py() or b"" for t in batch.column(at).cast(pa.large_binary()))


def _sent(batches, length):
    words = _Words(1)
    for batch in batches:
        counts, digests, hashes = [], [], []
        for text in _texts(batch, 2):
            found = text.split()
            counts.append(len(found))
            digests.append(xxhash.xxh3_128_digest(b" ".join(found)))
            hashes.append(np.unique(_halves(found, words, length)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), _lists(hashes)],
            ["doc_id", "tkey", "n_words", "digest", "anchors"])


def _extended(batches, length):
    """Windows of the full length around repeated halves: a row for every place."""
    words, other = _Words(1), _Words(2)
    cat = np.concatenate
    for batch in batches:
        rows, ones, twos, places = [], [], [], []
        for i, (text, anchors) in enumerate(zip(_texts(batch, 2), batch.column(3), strict=True)):
            found = text.split()
            again = np.asarray(anchors.values).view(np.uint64)
            at = np.flatnonzero(np.isin(_halves(found, words, length), again))
            ones.append(window_hashes(words(found), length)[at])
            twos.append(window_hashes(other(found), length)[at])
            places.append(at.astype(np.int64))
            rows.append(np.full(len(at), i, np.int64))
        if rows:
            of = pa.array(cat(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(of), batch.column(1).take(of), pa.array(cat(ones).view(np.int64)), pa.array(cat(twos).view(np.int64)), pa.array(cat(places))],
                ["doc_id", "tkey", "h1", "h2", "at"])


def _doubled(batches, length):
    """From windows sorted by document and place: those of twice the length, where the window that follows is there too.

    Holds one document's windows besides a batch.
    """
    names = ["doc_id", "tkey", "h1", "h2", "at"]
    held = [np.empty(0, np.int64)] * 5

    def joined(doc, tkey, one, two, at):
        of = np.cumsum(np.r_[0, (doc[1:] != doc[:-1]) | (tkey[1:] != tkey[:-1])])
        key = (of << 40) + at
        next_ = np.minimum(np.searchsorted(key, key + length), len(key) - 1)
        first = np.flatnonzero(key[next_] == key + length)
        last = next_[first]
        longer = [_mix(h[first].view(np.uint64), h[last].view(np.uint64)).view(np.int64) for h in (one, two)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (doc[first], tkey[first], *longer, at[first])], names)

    for batch in batches:
        cols = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns, strict=True)]
        other = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1])) if len(cols[0]) else []
        cut = other[-1] + 1 if len(other) else 0
        held = [c[cut:] for c in cols]
        if cut:
            yield joined(*[c[:cut] for c in cols])
    if len(held[0]):
        yield joined(*held)


def covered(n: int, places: list[int], length: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that starts at one of ``places``."""
    at = np.asarray(places, np.int64)
    edge = np.bincount(at, minlength=n + 1) - np.bincount(at + length, minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def _cut(batches, length, render):
    names, kinds = render.fields
    for batch in batches:
        out = []
        texts = batch.column(1).cast(pa.large_binary())
        for text, places, whole in zip(texts, batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            raw = text.as_py()
            found = (raw or b"").split()
            if whole:
                gone = np.ones(len(found), bool)
            elif places:
                gone = covered(len(found), places, length)
            else:
                gone = np.zeros(len(found), bool)
            out.append(render(raw, found, gone))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], batch.column(4)], ["row", *names, "longest"])


def digest_of(raw, found, gone):
    """n_words, n_removed and the SHA-256 of the kept words joined by one space."""
    kept = found if not gone.any() else [w for w, g in zip(found, gone, strict=True) if not g]
    return len(found), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()


digest_of.fields = ["n_words", "n_removed", "kept_sha256"], [pa.int64(), pa.int64(), pa.string()]
digest_of.schema = "n_words long, n_removed long, kept_sha256 string"


def text_of(raw, found, gone):
    """The text without the removed words; white space before a removed word goes with it."""
    if raw is None or not gone.any():
        return (None if raw is None else raw.decode(), int(gone.sum()))
    parts, at, kept = [], 0, 0
    for w, g in zip(found, gone, strict=True):
        start = raw.index(w, at)
        if g:
            parts.append(raw[kept:at])
            kept = start + len(w)
        at = start + len(w)
    parts.append(raw[kept:])
    return b"".join(parts).decode().lstrip(" \t\n\v\f\r"), int(gone.sum())


text_of.fields = ["text", "n_removed"], [pa.string(), pa.int64()]
text_of.schema = "text string, n_removed long"


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, text and a key of the text: rows may share a doc_id."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tkey"), text.alias("text"))


IDS = ["doc_id", "tkey"]
WINDOW = [*IDS, "h1", "h2", "at"]
SENT = "doc_id long, tkey long, n_words long, digest binary, anchors array<long>"


def _wider(rows: DataFrame, sent: DataFrame, length: int) -> DataFrame:
    """Halves that several documents have, extended to windows of ``length`` (doc_id, tkey, h1, h2, at)."""
    each = store(sent.select(*IDS, F.explode("anchors").alias("h")), "halves")
    often = store(_shared(each, ["h"]).select("h"), "often")
    again = store(each.join(often, "h").groupBy(*IDS).agg(F.collect_list("h").alias("anchors")), "again")
    drop(rows.sparkSession, each, often)
    wide = rows.join(again.hint("shuffle_hash"), IDS).select(*IDS, "text", "anchors")
    found = store(wide.mapInArrow(partial(_extended, length=length), "doc_id long, tkey long, h1 long, h2 long, at long"), "windows")
    del wide
    drop(rows.sparkSession, again)
    return found


def _shared(windows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, low): what more than one document has, with the smallest doc_id."""
    return windows.groupBy(*keys).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("high > low").drop("high")


def _levels(found: DataFrame, length: int) -> list[tuple[int, DataFrame]]:
    """(length, windows that several documents have with the smallest doc_id, low) for each length, doubled until none do.

    ``found`` has windows of ``length`` (and is dropped).  A longer window's hash comes from its halves'.
    """
    out, keys, spark = [], ["h1", "h2"], found.sparkSession
    while True:
        # Written apart, so that the join's own exchanges can be split where a window is in very many documents.
        low = store(_shared(found, keys), "low")
        now = store(found.join(low, keys).select(*IDS, *keys, "at", "low"), "level")
        drop(spark, found, low)
        if now.isEmpty():
            return out
        out.append((length, now))
        placed = now.select(*WINDOW).repartition(*IDS).sortWithinPartitions(*IDS, "at")
        found, length = store(placed.mapInArrow(partial(_doubled, length=length), "doc_id long, tkey long, h1 long, h2 long, at long"), "pairs"), 2 * length
        del now, placed


def repeat_levels(docs: DataFrame, length: int = 50) -> DataFrame:
    """(length, doc_id, tkey, at): windows that several documents have, each at the last length at which it repeats."""
    rows = _rows(docs).filter("doc_id is not null").dropDuplicates(IDS)
    sent = store(rows.mapInArrow(partial(_sent, length=length), SENT).filter(F.col("n_words") >= length), "anchors")
    levels = _levels(_wider(rows, sent, length), length)
    done = sent.select(F.lit(length).cast("long").alias("length"), *IDS, F.lit(0).cast("long").alias("at")).limit(0)
    for i, (size, now) in enumerate(levels):
        last = now if i + 1 == len(levels) else now.join(levels[i + 1][1].select(*IDS, "at"), [*IDS, "at"], "left_anti")
        done = done.union(last.select(F.lit(size).cast("long").alias("length"), *IDS, "at"))
    return done


def repeated_windows(docs: DataFrame, length: int = 50) -> DataFrame:
    """(doc_id, tkey, places, whole, longest): what each document repeats of documents with a smaller doc_id.

    places: where windows of ``length`` words start that also start in such a document; whole: its word
    sequence is one that such a document has (places is then null); longest: the greatest of ``length``,
    doubled any number of times, of which a window repeats so.  Rows without repeats are absent, and
    so are those with a null doc_id or fewer words.  tkey is Spark's hash of the text: rows that share a
    doc_id are judged each by its own text, and never against one another.
    """
    rows = _rows(docs).filter("doc_id is not null")
    sent = store(rows.mapInArrow(partial(_sent, length=length), SENT).filter(F.col("n_words") >= length), "anchors")
    first = store(sent.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                  .filter("last > first").select("digest", "first"), "first")
    whole = store(sent.select(*IDS, "n_words", "digest").join(first, "digest").filter("doc_id > first").select(*IDS, "n_words").distinct(), "whole")
    alone = sent.select(*IDS, "anchors").join(whole, IDS, "left_anti").dropDuplicates(IDS)
    late = whole.select(*IDS, F.lit(None).cast("long").alias("at"), F.lit(True).alias("whole"),
                        (F.lit(length) * F.pow(2, F.floor(F.log2(F.col("n_words") / length) + 1e-9))).cast("long").alias("size"))
    levels = _levels(_wider(rows, alone, length), length)
    for size, now in levels:
        at = F.col("at") if size == length else F.lit(None).cast("long")
        late = late.union(now.filter("doc_id > low").select(*IDS, at, F.lit(False), F.lit(size).cast("long")))
    # As many places as the document has words at most; a null one is not collected.
    marks = store(late.groupBy(*IDS).agg(F.collect_list("at").alias("places"), F.max("whole").alias("whole"), F.max("size").alias("longest")), "repeats")
    drop(docs.sparkSession, sent, first, whole, *[now for _, now in levels])
    return marks


def _marked(docs: DataFrame, length: int, render) -> DataFrame:
    """``row``, a struct of the columns of ``docs`` but text in their order, the fields of ``render``, and longest."""
    others = [c for c in docs.columns if c != "text"]
    marks = repeated_windows(docs, length).select(
        F.col("doc_id").alias("_d"), F.col("tkey").alias("_t"), F.col("places").alias("_p"), F.col("whole").alias("_w"), F.col("longest").alias("_l"))
    inner = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]).alias("row"), F.col("text").cast("string").alias("text"))
    at = f"row.c{others.index('doc_id')}"
    joined = inner.join(
        marks.hint("shuffle_hash"), (F.col(at).cast("long") == F.col("_d")) & (F.xxhash64("text") == F.col("_t")), "left")
    row = inner.schema["row"].dataType.simpleString()
    return joined.select("row", "text", "_p", "_w", F.coalesce("_l", F.lit(0)).cast("long").alias("longest")).mapInArrow(
        partial(_cut, length=length, render=render), f"row {row}, {render.schema}, longest long")


def remove_repeats(docs: DataFrame, length: int = 50, render=text_of) -> DataFrame:
    """``docs`` without the words that lie in windows an earlier document has.

    With ``text_of`` the columns of ``docs``, text cut, and n_removed and longest (see
    ``repeated_windows``; 0 without repeats); with ``digest_of`` the columns but text, and n_words, n_removed,
    kept_sha256 and longest.  Columns of ``docs`` that have these names give way.  Windows are
    judged on the input.  Null or empty texts, texts of fewer words and rows with
    a null doc_id stay as they are; repeated rows stay; an empty table gives an empty result.
    """
    new = [*render.fields[0], "longest"]
    others = [c for c in docs.columns if c != "text"]
    cut = _marked(docs, length, render).select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(others) if c not in new], *new)
    order = [c for c in docs.columns if c == "text" or c not in new] if render is text_of else [c for c in others if c not in new]
    return cut.select(*[F.col(f"`{c}`") for c in order], *[c for c in new if c not in order])


def cut_texts(docs: DataFrame, length: int = 50) -> DataFrame:
    """The columns of ``docs``, text without repeats as by ``remove_repeats``; n_chars, if there, follows cut texts."""
    cut, others = _marked(docs, length, text_of), [c for c in docs.columns if c != "text"]
    column = {c: F.col(f"row.c{i}") for i, c in enumerate(others)} | {"text": F.col("text")}
    if "n_chars" in column:
        column["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(column["n_chars"])
    return cut.select(*[column[c].alias(c) for c in docs.columns])


def sql(length: int = 50) -> str:
    """The query's digest as DuckDB SQL, over the windows themselves."""
    return f"""
with recursive d as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as l from documents),
starts as (select doc_id, l, unnest(generate_series(1, len(l) - {length - 1})) as i from d where len(l) >= {length}),
windows as (select doc_id, i, array_to_string(l[i:i + {length - 1}], ' ') as w from starts),
levels(len, doc_id, i, w, low) as (
  select {length}, doc_id, i, w, low from (select *, min(doc_id) over (partition by w) as low, max(doc_id) over (partition by w) as high from windows) where high > low
  union all select len, doc_id, i, w, low from (
    select *, min(doc_id) over (partition by w) as low, max(doc_id) over (partition by w) as high from (
      select 2 * a.len as len, a.doc_id, a.i, a.w || ' ' || b.w as w from levels a join levels b on b.doc_id = a.doc_id and b.i = a.i + a.len)) where high > low),
late as (select distinct doc_id, i from levels where doc_id > low and len = {length}),
longest as (select doc_id, max(len) as n from levels where doc_id > low group by 1),
gone as (select distinct doc_id, unnest(generate_series(i, i + {length - 1})) as i from late),
marked as (select d.doc_id, t.i, d.l[t.i] as w, g.i is not null as gone
  from (select doc_id, l, unnest(generate_series(1, len(l))) as i from d where len(l) > 0) t
  join d using (doc_id) left join gone g on g.doc_id = t.doc_id and g.i = t.i),
kept as (
  select doc_id, count(*) as n, count_if(gone) as r, string_agg(w, ' ' order by i) filter (where not gone) as k from marked group by 1)
select doc_id, coalesce(kept.n, 0)::bigint as n_words, coalesce(r, 0)::bigint as n_removed, sha256(coalesce(k, '')) as kept_sha256, coalesce(longest.n, 0)::bigint as longest
from d left join kept using (doc_id) left join longest using (doc_id)"""
