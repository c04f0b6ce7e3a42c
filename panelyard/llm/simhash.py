"""SimHash near-duplicates by covering locality-sensitive hashing.

A document's 64-bit fingerprint takes one majority vote per bit over the
XXH64 values of its word shingles.  Two documents are linked when their
fingerprints differ in at most ``radius`` bits; a class is a connected component
of these links.

Finding the links: every bit position gets a vector over the field of ``q``
elements with ``radius + 1`` entries, and every direction ``v`` gives a table
that keeps the bits whose vector is not orthogonal to ``v``.  The vectors of at
most ``radius`` differing bits leave some direction orthogonal to all of them, so
each pair within the radius agrees on all kept bits of at least one table: no
pair is lost, whatever the data.  With q = 2 there are 15 tables of about 34
bits for radius 3.  Buckets with more than ``bucket`` distinct fingerprints are
dealt again by the 156 tables of q = 5, which keep about 51 bits and 43 at least.  Distinct
fingerprints that share a bucket there differ in the other bits alone, 21 at most: whatever the
data, a task holds no more than 2**21 of them, 64 MB.

Exact copies meet before any search: only distinct fingerprints are dealt.  In a
bucket no pairs are listed; a search through the bucket finds its linked groups,
and each member is tied to its group's smallest document alone.
"""

from __future__ import annotations

from functools import partial
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import store
from .components import components

SEED = 42
BITS = 64
#: Fingerprints of one bucket that a task compares at once; larger buckets are dealt again.
BUCKET = 2000
_TOP = np.uint64(1 << 63)


def fingerprint(text: bytes, width: int = 3) -> int:
    """The SimHash of a UTF-8 text: A-Z lower-cased, words split at ASCII white space."""
    found = text.lower().split()
    if not found:
        return 0
    if len(found) < width:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(width)), strict=False))
    count = max(1, len(found) - width + 1)
    return votes(np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), np.uint64, count))


def votes(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes; 0 without any."""
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at:at + 4096].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches, width):
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary())
        prints = [fingerprint(t.as_py() or b"", width) for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(prints, np.uint64).view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed long; null or wordless text has 0."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        partial(_fingerprints, width=width), "doc_id long, fp long")


def masks(radius: int, q: int = 2) -> list[int]:
    """The covering tables' bit masks for a prime ``q``; see the module's text."""
    points = [v for v in product(range(q), repeat=radius + 1) if any(v) and next(x for x in v if x) == 1]
    step = next(s for s in range(len(points) // 2 or 1, 10**6) if np.gcd(s, len(points)) == 1)
    at = [points[i * step % len(points)] for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if sum(a * b for a, b in zip(v, at[i], strict=True)) % q) for v in points]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _groups(prints: np.ndarray, radius: int) -> np.ndarray:
    """For each of distinct fingerprints the index of its group's first member; links within ``radius``."""
    own = np.full(len(prints), -1)
    left = np.arange(len(prints))
    while len(left):
        first, left = left[0], left[1:]
        own[first] = first
        edge = np.array([first])
        while len(edge) and len(left):
            near = np.zeros(len(left), bool)
            step = max(1, (1 << 20) // len(left))
            for at in range(0, len(edge), step):
                apart = np.bitwise_count(prints[edge[at:at + step], None] ^ prints[left][None, :])
                near |= (apart <= radius).any(axis=0)
            edge, left = left[near], left[~near]
            own[edge] = first
    return own


def _edges(batches, radius, limit):
    """From rows sorted by bucket: edges (u, v), and the rows of buckets above ``limit`` as they are.

    Holds one bucket's first ``limit`` rows at most; the rest of a larger one passes through.
    """
    empty = np.empty(0, np.int64)
    held = [empty] * 4
    over = None

    def rows(kind, a, b):
        n = len(a)
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.array(a), pa.array(b)], ["kind", "a", "b"])

    def closed(cols):
        tab, key, fp, rep = cols
        cut = np.flatnonzero((tab[1:] != tab[:-1]) | (key[1:] != key[:-1])) + 1
        us, vs = [], []
        for lo, hi in zip(np.r_[0, cut], np.r_[cut, len(tab)], strict=True):
            if hi - lo < 2:
                continue
            part = rep[lo:hi]
            own = _groups(fp[lo:hi].view(np.uint64), radius)
            low = np.full(hi - lo, np.iinfo(np.int64).max)
            np.minimum.at(low, own, part)
            low = low[own]
            us.append(part[part != low])
            vs.append(low[part != low])
        if us:
            yield rows(0, np.concatenate(us), np.concatenate(vs))

    for batch in batches:
        cols = [np.concatenate([h, batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)]) for i, h in enumerate(held)]
        held = [empty] * 4
        if over is not None:
            same = (cols[0] == over[0]) & (cols[1] == over[1])
            if same.any():
                yield rows(1, cols[2][same], cols[3][same])
            cols = [c[~same] for c in cols]
        if not len(cols[0]):
            continue
        last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
        start = last[-1] + 1 if len(last) else 0
        whole, held = [c[:start] for c in cols], [c[start:] for c in cols]
        if limit:
            whole, big = _split(whole, limit)
            if len(big[0]):
                yield rows(1, big[2], big[3])
            if len(held[0]) > limit:
                over = held[0][0], held[1][0]
                yield rows(1, held[2], held[3])
                held = [empty] * 4
        if len(whole[0]):
            yield from closed(whole)
    if len(held[0]):
        yield from closed(held)


def _split(cols, limit):
    """Rows of buckets up to ``limit`` rows, and of those above."""
    if not len(cols[0]):
        return cols, cols
    cut = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])) + 1
    sizes = np.diff(np.r_[0, cut, len(cols[0])])
    big = np.repeat(sizes > limit, sizes)
    return [c[~big] for c in cols], [c[big] for c in cols]


def _deal(prints: DataFrame, radius: int, q: int, limit: int) -> DataFrame:
    spots = F.array(*[
        F.struct(F.lit(i).cast("long").alias("tab"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for i, m in enumerate(masks(radius, q))])
    dealt = prints.select(F.explode(spots).alias("s"), "fp", "rep").select("s.tab", "s.key", "fp", "rep")
    return (
        dealt.repartition("tab", "key").sortWithinPartitions("tab", "key", "fp")
        .mapInArrow(partial(_edges, radius=radius, limit=limit), "kind int, a long, b long"))


def link(prints: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Edges (u, v) between documents of different fingerprints within ``radius`` bits.

    ``prints`` has distinct ``fp`` with a document ``rep`` each.  The edges have the
    components of all links, but only as many rows as members of linked groups
    for each table.
    """
    first = store(_deal(prints, radius, 2, bucket), "links")
    edges = first.filter("kind = 0").select(F.col("a").alias("u"), F.col("b").alias("v"))
    large = first.filter("kind = 1")
    if not large.isEmpty():
        again = _deal(large.select(F.col("a").alias("fp"), F.col("b").alias("rep")).distinct(), radius, 5, 0)
        edges = edges.union(again.select(F.col("a").alias("u"), F.col("b").alias("v")))
    return edges


def near_duplicates(docs: DataFrame, radius: int = 3, width: int = 3, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    component_id: the smallest doc_id that links reach, the own one included.
    Rows with a null doc_id take no part as nodes: they get the component of
    their fingerprint if another row has it, else null.  Repeated rows stay.  An
    empty table gives an empty result.
    """
    prints = store(fingerprints(docs, width), "fingerprints")
    distinct = store(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    known = distinct.filter("rep is not null")
    labels = components(link(known, radius, bucket))
    classes = store(
        distinct.join(labels, distinct.rep == labels.node, "left")
        .select(F.col("fp").alias("_fp"), F.coalesce("component", "rep").alias("component_id")), "classes")
    return prints.join(classes, F.col("fp") == F.col("_fp"), "left").select("doc_id", "fp", "component_id")
