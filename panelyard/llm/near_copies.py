"""Near copies of whole texts: SimHash links, and MinHash signatures that agree in most places.

A document is its ``WIDTH``-word shingles (XXH64), lower-cased.  Two are linked if their SimHash
fingerprints differ in three bits at most (``simhash.link``), or if their signatures of ``MINIMA``
minima differ in ``APART`` places at most, an estimated Jaccard similarity of 0.755 and more: it
catches 95 % of the pairs at a similarity of 0.8, nearly all from 0.83 on, and few below 0.7.

The signature is cut into ``BANDS`` bands, one more than the places that may differ: every
such pair agrees on a whole band and so shares a bucket, for certain.  Only components are wanted, so
pairs are compared in three steps, none of which lists the pairs of a bucket:

1. every member with its bucket's smallest one;
2. ``ROUNDS`` times, in buckets that still hold several components, every member outside the
   first component with one member of it, another one each time;
3. in what is left, members outside the first component with all members, in blocks of ``BUCKET``
   rows each; a search through both blocks finds the linked groups, and each member is tied to
   its group's first.

Nodes are different texts' hashes (name), so equal texts meet beforehand.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import store, unused
from .components import components
from .simhash import link, votes

WIDTH = 5
BANDS, ROWS = 50, 4
MINIMA, APART = BANDS * ROWS, BANDS - 1
ROUNDS, BUCKET = 1, 2000
_rng = np.random.default_rng(42)
_A = _rng.integers(0, 1 << 31, (MINIMA, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, (MINIMA, 1), dtype=np.uint32)


def shingles(text: bytes, width: int = WIDTH) -> np.ndarray:
    """The hashes of a UTF-8 text's shingles, repeats included; words as in ``simhash.fingerprint``."""
    found = text.lower().split()
    parts = map(b" ".join, zip(*(found[i:] for i in range(width)), strict=False)) if len(found) > width else [b" ".join(found)] * bool(found)
    return np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=42), parts), np.uint64)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The signature: for each of the hash functions the least value over the shingles."""
    low = np.full(MINIMA, np.iinfo(np.uint32).max)
    own = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    for at in range(0, len(own), 512):
        x = own[None, at:at + 512] * _A
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        x += _B
        low = np.minimum(low, x.min(axis=1))
    return low


def signature(low: np.ndarray) -> np.ndarray:
    """A byte of each minimum: two that differ are taken for equal once in 256 times."""
    return ((low * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def _prints(batches, width):
    for batch in batches:
        out = [[], [], [], []]
        for text in batch.column(2).cast(pa.large_binary()):
            hashes = shingles(text.as_py() or b"", width)
            fp, low = votes(hashes), minima(hashes)
            out[0].append(xxhash.xxh64_intdigest(low.tobytes(), seed=fp))
            out[1].append(fp)
            out[2].append(signature(low).tobytes())
            out[3].append(np.array([xxhash.xxh64_intdigest(r.tobytes(), seed=i) for i, r in enumerate(low.reshape(BANDS, ROWS))] if len(hashes) else [], np.uint64).view(np.int64))
        longs = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in out[:2]]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *longs, pa.array(out[2], pa.binary()), pa.array(out[3], pa.list_(pa.int64()))], ["doc_id", "tkey", "name", "fp", "sig", "keys"])


def _compared(batches):
    """Of pairs (u, v, signatures) those that agree."""
    for batch in batches:
        a, b = (np.array([np.frombuffer(x, np.uint8) for x in batch.column(i).to_pylist()]).reshape(-1, MINIMA) for i in (2, 3))
        near = pa.array((a != b).sum(axis=1) <= APART)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], ["u", "v"])


def groups(sigs: np.ndarray) -> np.ndarray:
    """For each signature the index of its group's first member; links between those that agree."""
    own = np.full(len(sigs), -1)
    left = np.arange(len(sigs))
    while len(left):
        first, left = left[0], left[1:]
        own[first] = first
        edge = np.array([first])
        while len(edge) and len(left):
            near = np.zeros(len(left), bool)
            step = max(1, 40_000 // len(left))
            for at in range(0, len(edge), step):
                near |= ((sigs[edge[at:at + step], None] != sigs[None, left]).sum(axis=2) <= APART).any(axis=0)
            edge, left = left[near], left[~near]
            own[edge] = first
    return own


def _searched(batches):
    """From rows (key, block, chunk, name, sig) sorted by the first three: edges. Holds one group at a time, of two blocks at most."""
    def closed(rows):
        names = np.array([r["name"] for r in rows], np.int64)
        own = groups(np.array([np.frombuffer(r["sig"], np.uint8) for r in rows]))
        tied = own != np.arange(len(own))
        return pa.RecordBatch.from_arrays([pa.array(names[tied]), pa.array(names[own[tied]])], ["u", "v"])

    held, at = [], None
    for batch in batches:
        for row in batch.to_pylist():
            spot = row["key"], row["block"], row["chunk"]
            if spot != at and held:
                yield closed(held)
                held = []
            at = spot
            held.append(row)
    if held:
        yield closed(held)


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges (u, v) between names, with the components of all pairs whose signatures agree.

    ``prints`` has distinct ``name`` with ``sig`` and ``keys``.
    """
    sigs = prints.select("name", "sig")
    dealt = prints.select("name", F.explode("keys").alias("key"))
    several = dealt.groupBy("key").agg(F.min("name").alias("low"), F.count("*").alias("n")).filter("n > 1").select("key", "low")
    members = store(dealt.join(several, "key"), "members")

    def agreeing(pairs: DataFrame) -> DataFrame:
        both = pairs.distinct().join(sigs.select(F.col("name").alias("u"), F.col("sig").alias("a")), "u").join(sigs.select(F.col("name").alias("v"), F.col("sig").alias("b")), "v")
        return store(both.select("u", "v", "a", "b").mapInArrow(_compared, "u long, v long"), "agreeing")

    edges = agreeing(members.filter("name <> low").select(F.col("name").alias("u"), F.col("low").alias("v")))
    for i in range(ROUNDS + 1):
        part = components(edges)
        placed = members.join(part, F.col("name") == F.col("node"), "left").select("key", "name", F.coalesce("component", "name").alias("part"))
        first = placed.groupBy("key").agg(
            F.min(F.struct("part", F.xxhash64(F.lit(i), "name").alias("h"), "name")).alias("first"), F.max("part").alias("last"), F.count("*").alias("n"))
        mixed = first.filter("first.part < last").select("key", F.col("first.part").alias("low"), F.col("first.name").alias("v"), "n")
        if i < ROUNDS:
            edges = store(edges.union(agreeing(placed.join(mixed, "key").filter("part <> low").select(F.col("name").alias("u"), "v"))), "edges")
        members = store(placed.join(mixed.select("key"), "key", "left_semi").select("key", "name", "part"), "open").drop("part") if i < ROUNDS else store(placed.join(mixed, "key").select("key", "name", "part", "low", "n"), "open")
    outside = members.filter("part <> low")
    sizes = members.groupBy("key").agg(F.count_if(F.col("part") != F.col("low")).alias("m"), F.max("n").alias("n")).select(
        "key", F.ceil(F.col("m") / bucket).cast("int").alias("blocks"), F.ceil(F.col("n") / bucket).cast("int").alias("chunks"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    spot = lambda n: F.pmod(F.xxhash64("name"), F.col(n)).cast("int")
    asked = outside.join(sizes, "key").select("key", spot("blocks").alias("block"), each("chunks").alias("chunk"), "name")
    all_ = members.join(sizes, "key").select("key", each("blocks").alias("block"), spot("chunks").alias("chunk"), "name")
    rows = asked.union(all_).distinct().join(sigs, "name").select("key", "block", "chunk", "name", "sig")
    rest = rows.repartition("key", "block", "chunk").sortWithinPartitions("key", "block", "chunk", "name").mapInArrow(_searched, "u long, v long")
    return edges.union(rest)


def classes(docs: DataFrame, width: int = WIDTH, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, tkey, stays): every different text of every document, and whether it is its class's first.

    tkey: Spark's hash of the text.  The first has the smallest doc_id, and of one document's several
    texts the smallest tkey.  Rows with a null doc_id take no part; texts without words are one class.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tkey"), text.alias("text")).filter("doc_id is not null")
    prints = store(rows.mapInArrow(partial(_prints, width=width), "doc_id long, tkey long, name long, fp long, sig binary, keys array<long>"), "prints")
    names = store(prints.groupBy("name").agg(F.first("fp").alias("fp"), F.first("sig").alias("sig"), F.first("keys").alias("keys")), "names")
    marks = store(names.groupBy("fp").agg(F.min("name").alias("rep")), "marks")
    same = names.select("name", "fp").join(marks, "fp").filter("name <> rep").select(F.col("name").alias("u"), F.col("rep").alias("v"))
    part = components(same.union(link(marks)).union(links(names, bucket)))
    whole = prints.select("doc_id", "tkey", "name").distinct().join(part, F.col("name") == F.col("node"), "left").select("doc_id", "tkey", F.coalesce("component", "name").alias("part"))
    whole = store(whole, "placed")
    first = whole.groupBy("part").agg(F.min(F.struct("doc_id", "tkey")).alias("first"))
    return whole.join(first, "part").select("doc_id", "tkey", (F.struct("doc_id", "tkey") == F.col("first")).alias("stays"))


def kept(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, as they are, but for near copies of an earlier document.

    Rows are told apart by doc_id and text; rows equal in both stay or go together.  Rows with a null doc_id stay.
    """
    id_, key = unused(docs, "_id", "_key")
    gone = store(classes(docs, **options).filter("not stays").select(F.col("doc_id").alias(id_), F.col("tkey").alias(key)), "gone")
    same = (F.col("doc_id").cast("long") == F.col(id_)) & (F.xxhash64(F.col("text").cast("string")) == F.col(key))
    return docs.join(gone.hint("shuffle_hash"), same, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
