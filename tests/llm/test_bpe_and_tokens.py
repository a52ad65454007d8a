"""BPE by segment tree, and the packed ids, against the tokenizers library."""

import hashlib
import random
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import SF0001
from helpers import CLASHING, LONG, table
from ledgerlens.llm import bpe_segment as B
from ledgerlens.llm import tokens as T
from ledgerlens.llm.common import documents
from tokenizers import Tokenizer

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module", params=[B.SegmentEncoder, T.JoinedEncoder])
def encode(request):
    return request.param(T.ranks_path())


def ids_of(texts, encode):
    ids, ends = T.encode_block(pa.array(texts, pa.string()), encode)
    return [x.tolist() for x in np.split(ids, ends[:-1])]


def want(texts):
    return [e.ids for e in LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)]


AWKWARD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "\na b\n", "a b c", "\x1c x\x1d y", "a \u0085b",
    "x<|endoftext|>y <|endoftext|> z", "<|endoftext|>", "<|endoftext|><|endoftext|> a b", "don't we'll I've 's 'S",
    "é ü 漢字 🙂 ‍👩‍👩", "a" * 5000, "ab" * 1777, "!" * 999 + " " * 700 + "?", "1234567890" * 30, LONG[:3000], "　x 　",
]


def test_awkward_texts(encode):
    assert ids_of(AWKWARD, encode) == want(AWKWARD)
    for text in AWKWARD:  # alone in a block, too
        assert ids_of([text], encode) == want([text])


def test_random_texts_of_all_planes(encode):
    rng = random.Random(11)
    kinds = [lambda: rng.randrange(32, 127), lambda: rng.randrange(0x500), lambda: rng.randrange(0xD800), lambda: 32]
    texts = ["".join(chr(rng.choice(kinds)()) for _ in range(rng.randint(0, 120))) for _ in range(600)]
    assert ids_of(texts, encode) == want(texts)


def test_every_kind_of_character_at_a_cut(encode):
    seen, texts = {}, []
    for c in map(chr, [*range(0xD800), *range(0xE000, 0x20000)]):
        kind = unicodedata.category(c)
        if seen.setdefault(kind, 0) < 60 and kind != "Cn":
            seen[kind] += 1
            texts.append(f"a{c} b {c}c d{c}{c} {c} e")
    assert ids_of(texts, encode) == want(texts)


def test_merge_of_a_forest_is_the_leftmost_lowest_rank_merge():
    encode = B.SegmentEncoder(T.ranks_path())
    rng = random.Random(5)
    words = ["".join(rng.choice("abcde thern") for _ in range(rng.randint(1, 40))).encode() for _ in range(300)]

    def plain(word):
        parts = [bytes([b]) for b in word]
        while True:
            ranks = [(encode.ranks.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            if not ranks or min(ranks)[0] == 1 << 30:
                return [encode.ranks[p] for p in parts]
            i = min(ranks)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    ids, counts = encode.pieces(words)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [plain(w) for w in words]


def test_whole_table_and_awkward_rows(spark):
    for docs in (documents(spark, SF0001), table(spark, clash=CLASHING), table(spark).limit(0)):
        rows = docs.select("doc_id", "text").collect()
        expected = []
        for (doc_id, text), ids in zip(rows, want([r["text"] for r in rows]) if rows else []):
            coded = ",".join(map(str, ids)).encode()
            decoded = LIBRARY.decode(ids, skip_special_tokens=False).encode()
            assert decoded.decode() == (text or "")
            expected.append((doc_id, len(ids), hashlib.sha256(coded).hexdigest(), hashlib.sha256(decoded).hexdigest()))
        assert sorted(map(tuple, B.code(docs).collect()), key=repr) == sorted(expected, key=repr)


def test_decoding_ids_that_are_no_utf8():
    decode = B.Decoder(T.load_ranks(T.ranks_path()))
    rng = random.Random(2)
    for _ in range(200):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 12))]
        assert decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)
