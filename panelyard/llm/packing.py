"""Best-fit packing of tokenized documents into sequences: pattern packing.

Documents become token ids; only those longer than a sequence are cut.  What is
packed is a histogram of piece lengths: patterns of few documents that fill a
sequence exactly are enumerated, their repeat counts are fitted to the histogram
by non-negative least squares (coordinate descent), rounded down, and what the
patterns leave is packed by best fit over counts.  The result is a plan whose size
depends on the number of different lengths, not on the corpus: for each length,
which ranks go to which run of sequences at which offset.  Pieces get exact ranks
within their length and look their place up.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import store
from .ranking import rank_in_groups

#: Pre-tokens kept in a worker's cache of token ids.
CACHE = 700_000
#: Characters for which Python's lower-casing and classes are the tokenizer's: Latin letters, composed, and common marks.
_PLAIN = re.compile("[\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u012f\u0131-\u024f\u2010-\u2027\u20ac]*")
#: The tokenizer's own cut of a text, on such characters: contractions, letters, single digits, marks.
_CUT = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|\d|(?:[^\w\s]|_)+")


class Encoder:
    """Token ids of whole texts as little-endian 32-bit bytes, one end id after each.

    The tokenizer cuts lower-cased text into runs of letters, digits or marks and encodes
    each by itself; so does this, keeping the runs it has met and encoding new ones many at
    a time.  Texts with other characters than Latin ones, or with the special tokens' marks,
    go to the tokenizer as a whole.
    """

    def __init__(self, path: str, end: int = 0):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.end = np.uint32(end).tobytes()
        self.known: dict[str, bytes] = {}
        self.marks = [t.content for t in self.tok.get_added_tokens_decoder().values()]

    def whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, runs: list[str]) -> None:
        """Ids of different runs, each one word to the tokenizer."""
        if len(self.known) > CACHE:
            self.known.clear()
        for at in range(0, len(runs), 4096):
            part = runs[at:at + 4096]
            e = self.tok.encode(" ".join(part), add_special_tokens=False)
            ids, cut = np.array(e.ids, "<u4"), np.flatnonzero(np.diff(np.array(e.word_ids, np.int64))) + 1
            if len(cut) + 1 == len(part):
                raw, ends = ids.tobytes(), [0, *(4 * cut).tolist(), 4 * len(ids)]
                self.known.update((r, raw[i:j]) for r, i, j in zip(part, ends, ends[1:], strict=False))
            else:
                self.known.update((r, self.whole(r)) for r in part)

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return self.end
        if not _PLAIN.fullmatch(text) or any(m in text for m in self.marks):
            return self.whole(text) + self.end
        found, known = _CUT.findall(text.lower()), self.known
        ids = list(map(known.get, found))
        if None in ids:
            new = [i for i, x in enumerate(ids) if x is None]
            self._learn(list({found[i] for i in new}))
            for i in new:
                ids[i] = known[found[i]]
        return b"".join(ids) + self.end


@lru_cache(1)
def _encoder(path: str, end: int) -> Encoder:
    """A worker's encoder, with what it met in earlier tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path, end)


def _pieces(batches, path, limit, end):
    encode = _encoder(path, end)
    for batch in batches:
        row, piece, start, length, crc = [], [], [], [], []
        for i, text in enumerate(batch.column(1)):
            ids = encode(text.as_py())
            for p, at in enumerate(range(0, len(ids), 4 * limit)):
                part = ids[at:at + 4 * limit]
                row.append(i)
                piece.append(p)
                start.append(at // 4)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]],
            ["doc_id", "piece", "start", "length", "ids_crc32"])


def pieces(docs: DataFrame, path: str, limit: int = 2048, end: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row of ``docs``; empty or null text is one piece, the end id."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        partial(_pieces, path=path, limit=limit, end=end),
        "doc_id long, piece int, start long, length long, ids_crc32 long")


def patterns(lengths: np.ndarray, limit: int) -> np.ndarray:
    """All ways to fill ``limit`` exactly with one, two or three of ``lengths``; rows of three, zero-filled."""
    there = np.zeros(limit + 1, bool)
    there[lengths] = True
    found = [np.array([[limit, 0, 0]])] if there[limit] else []
    a = lengths[lengths * 2 <= limit]
    two = a[there[limit - a]]
    found.append(np.stack([two, limit - two, 0 * two], 1))
    for x in lengths[lengths * 3 <= limit]:
        y = lengths[(lengths >= x) & (x + 2 * lengths <= limit)]
        y = y[there[limit - x - y]]
        found.append(np.stack([np.full(len(y), x), y, limit - x - y], 1))
    return np.concatenate(found)


def fit_patterns(histogram: np.ndarray, rows: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Non-negative repeat counts x that make the patterns' lengths come near ``histogram``.

    Least squares by coordinate descent: each round moves, among the patterns with
    the largest gradient, those that share no length, each to its own optimum, down
    to zero if need be.
    """
    x = np.zeros(len(rows))
    left = histogram.astype(float)
    left[0] = 0
    same = (rows[:, :1] == rows[:, 1:2]) & (rows[:, 1:2] > 0)
    same2 = (rows[:, 1:2] == rows[:, 2:3]) & (rows[:, 2:3] > 0)
    norm = (rows > 0).sum(1) + 2 * same[:, 0] + 2 * same2[:, 0] + 2 * (same & same2)[:, 0]
    for _ in range(rounds):
        gain = np.maximum(left[rows].sum(1) / norm, -x)
        best = np.argsort(-np.abs(gain) * np.sqrt(norm))[:8192]
        used, moved = set(), False
        for j in best:
            if abs(gain[j]) < 0.5:
                break
            own = set(rows[j].tolist()) - {0}
            if used.isdisjoint(own):
                used |= own
                x[j] += gain[j]
                np.subtract.at(left, rows[j], gain[j])
                moved = True
        left[0] = 0
        if not moved:
            break
    return x


def plan(histogram: np.ndarray, limit: int) -> np.ndarray:
    """Rows (length, first rank, count, first sequence, offset): count pieces of that length from
    that rank on go, one each, to consecutive sequences from the first on, all at the offset."""
    left = histogram.astype(np.int64).copy()
    used = np.zeros_like(left)
    out: list[tuple[int, int, int, int, int]] = []
    next_sequence = 0

    def put(length, count, sequence, offset):
        out.append((length, int(used[length]), count, sequence, offset))
        used[length] += count
        left[length] -= count

    lengths = np.flatnonzero(left)
    if not len(lengths):
        return np.empty((0, 5), np.int64)
    rows = patterns(lengths, limit)
    fitted = np.floor(fit_patterns(left, rows) + 1e-9).astype(np.int64) if len(rows) else np.empty(0, np.int64)
    for j in np.argsort(-fitted, kind="stable"):
        parts = [int(p) for p in rows[j] if p]
        times = min([int(fitted[j]), *(int(left[p]) // parts.count(p) for p in parts)])
        if fitted[j] <= 0:
            break
        if times <= 0:
            continue
        at = 0
        for p in parts:
            put(p, times, next_sequence, at)
            at += p
        next_sequence += times
    # Best fit over counts, long to short; runs of sequences with the same room.
    rooms: list[int] = []
    runs: dict[int, list[tuple[int, int]]] = {}

    def free(room, sequence, count):
        if room and count:
            if room not in runs:
                runs[room] = []
                insort(rooms, room)
            runs[room].append((sequence, count))

    for length in np.flatnonzero(left)[::-1].tolist():
        while left[length]:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                if length * 2 > limit or left[length] < limit // length:
                    n = int(left[length]) if length * 2 > limit else 1
                    each = 1 if length * 2 > limit else int(left[length])
                else:
                    each = limit // length
                    n = int(left[length]) // each
                for k in range(each):
                    put(length, n, next_sequence, k * length)
                free(limit - each * length, next_sequence, n)
                next_sequence += n
                continue
            room = rooms[at]
            sequence, count = runs[room].pop()
            if not runs[room]:
                del runs[room]
                rooms.pop(at)
            n = min(count, int(left[length]))
            put(length, n, sequence, limit - room)
            free(room - length, sequence, n)
            free(room, sequence + n, count - n)
    return np.array(sorted(out), np.int64)


def _placed(batches, table):
    keys = table[:, 0] << 48 | table[:, 1]
    for batch in batches:
        col = lambda n: batch.column(n).to_numpy(zero_copy_only=False)  # noqa: B023, E731
        rank = col("rank")
        row = np.searchsorted(keys, col("length") << 48 | rank, side="right") - 1
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")],
             pa.array(table[row, 3] + rank - table[row, 1]), pa.array(table[row, 4])],
            ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pack(docs: DataFrame, path: str, limit: int = 2048, end: int = 0) -> DataFrame:
    """Every piece of every row of ``docs`` with its sequence and its place in it.

    ``path``: a tokenizer file of the tokenizers library.  Null and empty texts are the end
    id alone; repeated rows are packed once each; null doc_ids stay null.  An empty
    table gives an empty result.  The driver holds the histogram (``limit`` counts)
    and the plan, both bounded by ``limit``.
    """
    cut = store(pieces(docs, path, limit, end), "pieces")
    counts = np.zeros(limit + 1, np.int64)
    for length, n in cut.groupBy("length").agg(F.count("*")).collect():
        counts[length] = n
    table = plan(counts, limit)
    ranked = rank_in_groups(cut.withColumn("h", F.xxhash64("doc_id", "piece", "ids_crc32")), ["length"], ["h", "doc_id", "piece"])
    return ranked.mapInArrow(partial(_placed, table=table), SCHEMA)


def sequences(placed: DataFrame, docs: DataFrame, path: str, end: int = 0) -> DataFrame:
    """(sequence_id, doc_id, offset, ids): the placed pieces' token ids, for documents with distinct doc_ids."""
    def filled(batches):
        encode = Encoder(path, end)
        for batch in batches:
            start, length = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            ids = [np.frombuffer(encode(t.as_py()), "<u4")[s:s + n].astype(np.int32) for t, s, n in zip(batch.column(0), start, length, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(3), batch.column(4), batch.column(5), pa.array(ids, pa.list_(pa.int32()))], ["sequence_id", "doc_id", "offset", "ids"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(placed, "doc_id").select("text", "start", "length", "sequence_id", "doc_id", "offset")
    return rows.mapInArrow(filled, "sequence_id long, doc_id long, offset long, ids array<int>")
