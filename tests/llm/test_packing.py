import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from panelyard.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("text", ["", "One two\x0bthree\x0cfour", "a\x1cb \x1d", "x<|endoftext|>y z", "É́é don't I'll 12ab", "́ a", "a b c\x85d　e", "İΣς ΑΣ ẞ", "한가 ᄀ ᅡ", "a​b ﻿c", "##$$ %% e.g. x_y"])
def test_words_give_the_texts_ids(text):
    assert np.frombuffer(packing.Encoder(PATH)(text), "<u4").tolist() == ids(text)


def check(docs, limit=2048, slack=1.02):
    tok = Tokenizer.from_file(PATH)
    rows = docs.select("doc_id", "text").collect()
    encoded = [[*e.ids, 0] for e in tok.encode_batch([r.text or "" for r in rows], add_special_tokens=False)]
    want = sorted(str((r.doc_id, p, at, len(part := e[at:at + limit]), zlib.crc32(np.array(part, "<u4").tobytes())))
                  for r, e in zip(rows, encoded, strict=True) for p, at in enumerate(range(0, len(e), limit)))
    got = packing.pack(docs, PATH, limit).collect()
    assert sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in got) == want
    full = {}
    for r in got:
        full.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in full.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    least = -(-sum(r.length for r in got) // limit)
    assert len(full) <= max(least * slack, least + 2)


def test_table(spark, sf):
    check(spark.read.parquet(f"{sf}/documents.parquet"), slack=1.05)


def test_odd(odd_docs, no_docs):
    check(odd_docs)
    check(odd_docs, 64, slack=1.1)
    assert packing.pack(no_docs, PATH).count() == 0


def test_plan_places_every_piece_once():
    rng = np.random.default_rng(2)
    for _ in range(30):
        limit = int(rng.integers(5, 200))
        histogram = rng.poisson(rng.choice([0.5, 5, 300]), limit + 1)
        histogram[0] = 0
        table = packing.plan(histogram, limit)
        room, ranks = {}, {}
        for length, first, count, sequence, offset in table.tolist():
            assert ranks.get(length, 0) == first
            ranks[length] = first + count
            for i in range(count):
                room.setdefault(sequence + i, []).append((offset, length))
        assert all(ranks.get(n, 0) == h for n, h in enumerate(histogram))
        for parts in room.values():
            assert [o for o, _ in sorted(parts)] == np.cumsum([0, *[n for _, n in sorted(parts)]])[:-1].tolist()
            assert sum(n for _, n in parts) <= limit
        least = -(-int((np.arange(limit + 1) * histogram).sum()) // limit)
        if histogram.sum() > 50 * limit:
            assert len(room) <= 1.05 * max(least, sum(histogram[limit // 2 + 1:]))


def test_sequences_hold_the_ids(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id < 40")
    placed = packing.pack(docs, PATH)
    text = {r.doc_id: r.text for r in docs.collect()}
    got = packing.sequences(placed, docs, PATH).join(placed.select("sequence_id", "offset", "start"), ["sequence_id", "offset"]).collect()
    assert len(got) == placed.count()
    for r in got:
        assert r.ids == ids(text[r.doc_id])[r.start:r.start + 2048]
