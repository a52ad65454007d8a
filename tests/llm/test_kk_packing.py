"""Packing: every id once, no sequence over its capacity, little padding."""

import random
import zlib

import numpy as np
import public_tokenizers
from conftest import SF0001
from helpers import CLASHING, table
from ledgerlens.llm import kk_packing as K
from ledgerlens.llm.common import documents
from tokenizers import Tokenizer

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(pieces, docs, capacity=1024):
    """Pieces against the ids of the tokenizers library; returns the share of padding."""
    ids = {}
    for r in docs.collect():
        own = LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        ids.setdefault(r["doc_id"], []).append(np.array(own, "<u4"))
    held = {}
    for p in pieces:
        held.setdefault(p["doc_id"], []).append(p)
    assert held.keys() == ids.keys()
    for doc_id, versions in ids.items():
        cover = sorted((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in held[doc_id])
        spans = []
        for own in versions:
            at = [x for x in cover if x[3] == len(own)]
            assert sum(x[1] for x in at) % len(own) == 0
            for start, length, crc, _ in at:
                if zlib.crc32(own[start : start + length].tobytes()) == crc:
                    spans.append((start, length))
        assert len(spans) >= len(cover)
        assert sum(x[1] for x in cover) == sum(map(len, versions))
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    total = sum(p["length"] for p in pieces)
    return 1 - total / (capacity * len(sequences)) if sequences else 0.0


def test_whole_table(spark):
    docs = documents(spark, SF0001)
    assert check(K.pack(docs).collect(), docs) < 0.02


def test_awkward_rows(spark):
    docs = table(spark, clash=CLASHING)
    check(K.pack(docs).collect(), docs)
    assert K.pack(docs.limit(0)).count() == 0
    one = table(spark, [(1, None)])
    assert [tuple(r)[:5] for r in K.pack(one).collect()] == [(1, 0, 1, zlib.crc32(b"\0" * 4), 1)]


def test_small_pools_and_capacities(spark):
    docs = documents(spark, SF0001).repartition(5)
    check(K.pack(docs, capacity=64, max_piece=9, pool_ids=500).collect(), docs, capacity=64)


def test_differencing_is_near_equal_and_windows_rise():
    rng = random.Random(4)
    for _ in range(50):
        sizes = [rng.randint(1, 192) for _ in range(rng.randint(0, 300))]
        windows = K.pack_pool(sizes)
        assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in w) <= K.CAPACITY for w in windows)
        assert len(windows) <= -(-sum(sizes) // K.CAPACITY) + 1
    # two of three items can't share a window: one more than the sum asks for
    assert len(K.pack_pool([600, 600, 600])) == 3
    sums = [sum(x) for x in ([[8, 7, 6, 5, 4][i] for i in w] for w in K.differencing([8, 7, 6, 5, 4], 2))]
    assert sorted(sums) == [14, 16]  # the classic example


def test_cuts_cover_a_document():
    for total in (1, 9, 1023, 1024, 1025, 5000):
        full, rest = K.cuts(total, 1024, 192)
        spans = sorted(full + rest)
        assert [s for s, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1]]
        assert sum(n for _, n in spans) == total and all(n <= 192 for _, n in rest)
