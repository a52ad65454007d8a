"""Alignment against both libraries and a quadratic reading of the definition."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from conftest import SF0001
from helpers import CLASHING, ROWS, table
from ledgerlens.llm import catalog
from ledgerlens.llm import token_align as A
from ledgerlens.llm.common import documents
from ledgerlens.llm.tokens import ranks_path
from tokenizers import Tokenizer

LIBRARY = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
LIBRARY.encode_special_tokens = True
MODEL = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def byte_table():
    """The printable stand-ins of byte-level BPE, as published with the method."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {}, 0
    for b in range(256):
        if b in plain:
            out[chr(b)] = b
        else:
            out[chr(256 + extra)] = b
            extra += 1
    return out


BYTES = byte_table()


def tokens_a(text):
    ids = LIBRARY.encode(" " + text, add_special_tokens=False).ids
    return [(i, bytes(BYTES[c] for c in LIBRARY.id_to_token(i))) for i in ids]


def tokens_b(text):
    out = []
    for i in MODEL.encode(text):
        piece = MODEL.id_to_piece(i)
        out.append((i, bytes([int(piece[3:5], 16)]) if MODEL.is_byte(i) else piece.replace("▁", " ").encode()))
    return out


def spans(tokens):
    out, at = [], 0
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def plain(text):
    """(n_a, n_b, groups as text, links) of one text."""
    if not text:
        return 0, 0, "", []
    a, b = tokens_a(text), tokens_b(text)
    want = (" " + text).encode()
    if b"".join(r for _, r in a) != want or b"".join(r for _, r in b) != want:
        return 0, 0, "", []
    a, b = spans(a), spans(b)
    links = [(x, y) for x, s, e in a for y, f, t in b if s < t and f < e] if len(a) < 600 else near(a, b)
    cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
    groups, low = [], 0
    pa_, pb = 0, 0
    for cut in cuts:
        left, right = [], []
        while pa_ < len(a) and a[pa_][2] <= cut:
            left.append(str(a[pa_][0]))
            pa_ += 1
        while pb < len(b) and b[pb][2] <= cut:
            right.append(str(b[pb][0]))
            pb += 1
        groups.append(",".join(left) + "|" + ",".join(right))
        low = cut
    assert low == len(want)
    return len(a), len(b), ";".join(groups), links


def near(a, b):
    """Links of a long text, two fingers."""
    links, j = [], 0
    for x, s, e in a:
        while b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < e:
            links.append((x, b[k][0]))
            k += 1
    return links


def expected(texts):
    each = [plain(t) for t in texts]
    held = Counter()
    for _, _, _, links in each:
        held.update(set(links))
    most = {}
    for (x, _), n in held.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for n_a, n_b, groups, links in each:
        sha = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
        n_groups = groups.count(";") + 1 if n_a else 0
        best = sum(held[p] == most[p[0]] for p in links)
        out.append((n_a, n_b, n_groups, len(links), best, sum(held[p] for p in links), sha))
    return out


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def result(df):
    return sorted(((r["doc_id"], *[r[c] for c in COLUMNS]) for r in df.collect()), key=repr)


def test_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in documents(spark, SF0001).collect()]
    want = sorted(((i, *e) for (i, _), e in zip(docs, expected([t for _, t in docs]))), key=repr)
    assert result(catalog.op11_token_align(spark, SF0001)) == want


AWKWARD = [
    (20, " leading space"),
    (21, "trailing space "),
    (22, "two  spaces"),
    (23, "a mark ▁ inside"),
    (24, "<s>plain</s> <unk> <|endoftext|>text<|endoftext|>"),
    (25, "\n\n\ttabs\n"),
    (26, "　wide space \U0001f642‍"),
    (27, "\x00nul"),
    (28, "word" * 5000),
    (None, "two  spaces"),
]


def test_awkward_rows(spark):
    rows = ROWS + AWKWARD
    docs = table(spark, rows, clash=(*CLASHING, "block", "pairs", "docs", "best", "a"))
    want = sorted(((i, *e) for (i, _), e in zip(rows, expected([t for _, t in rows]))), key=repr)
    assert result(A.aligned(docs)) == want
    assert A.aligned(docs.limit(0)).count() == 0
    nothing = table(spark, [(1, None), (2, "")])
    assert result(A.aligned(nothing)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_blocks_don_t_matter(spark, monkeypatch):
    """The same counts from one block and from a block a document."""
    docs = documents(spark, SF0001).limit(60)
    whole = result(A.aligned(docs.coalesce(1)))
    assert whole == result(A.aligned(docs.repartition(13)))
    a, b = A.sides(ranks_path(), A.pieces_path())
    names = pa.concat_arrays([A._texts_of_ids(a), A._texts_of_ids(b)])
    texts = pa.array([r["text"] for r in docs.collect()])
    together = A.align_block(texts, a, b, names)
    alone = [A.align_block(texts.slice(i, 1), a, b, names) for i in range(len(texts))]
    assert together.groups == [x.groups[0] for x in alone]
    assert together.n_links.tolist() == [int(x.n_links[0]) for x in alone]
    pairs = Counter()
    for x in alone:
        pairs.update(x.pairs.tolist())
    assert dict(zip(together.pairs.tolist(), together.docs.tolist())) == pairs


def test_groups_and_links(spark):
    docs = table(spark, [(1, "hello world"), (2, "hello there"), (3, None)])
    groups = {r["doc_id"]: r["groups"] for r in A.groups(docs).collect()}
    assert groups == {i: plain(t)[2] for i, t in [(1, "hello world"), (2, "hello there"), (3, None)]}
    held = {(r["a"], r["b"]): r["n"] for r in A.links(docs).collect()}
    both = Counter()
    for t in ("hello world", "hello there"):
        both.update(set(plain(t)[3]))
    assert held == both


def test_windows_of_one_hash_are_kept_apart(monkeypatch):
    """Colliding hashes change nothing: windows are compared id by id."""
    a, b = A.sides(ranks_path(), A.pieces_path())
    names = pa.concat_arrays([A._texts_of_ids(a), A._texts_of_ids(b)])
    texts = pa.array(["one two three one", "three two", "unbelievable things"])
    before = A.align_block(texts, a, b, names)
    monkeypatch.setattr(A, "_hashes", lambda ids, bounds: np.zeros(len(bounds) - 1, np.uint64))
    after = A.align_block(texts, a, b, names)
    assert before.groups == after.groups
    assert before.n_links.tolist() == after.n_links.tolist()


@pytest.mark.parametrize("text", ["a", " ", "  ", "é", "🙂", "a\nb", "x" * 999])
def test_small_texts(text):
    a, b = A.sides(ranks_path(), A.pieces_path())
    names = pa.concat_arrays([A._texts_of_ids(a), A._texts_of_ids(b)])
    got = A.align_block(pa.array([text]), a, b, names)
    n_a, n_b, groups, links = plain(text)
    assert (got.n_a[0], got.n_b[0], got.groups[0].decode(), got.n_links[0]) == (n_a, n_b, groups, len(links))
