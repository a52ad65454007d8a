"""Run-length index and removal of repeated passages against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF0001
from helpers import CLASHING, LONG, table
from ledgerlens.llm import rlbwt as R
from ledgerlens.llm.common import documents


def longest_matches(data):
    n, out = len(data), []
    for i in range(n):
        best = 0
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and data[i + k] == data[j + k]:
                k += 1
            best = max(best, k)
        out.append(best)
    return out


def test_matching_statistics_from_run_ends():
    rng = np.random.default_rng(3)
    samples = [b"", b"a", b"aa", b"ab" * 40, b"abc" * 30 + b"x" + b"abc" * 10, bytes(rng.integers(97, 99, 150).tolist()) * 2]
    samples += [bytes(rng.integers(97, 97 + k, 160).tolist()) for k in (1, 2, 3, 26)]
    samples.append(bytes(255 if i % 37 == 0 else 97 + i * i % 3 for i in range(200)))
    for data in samples:
        assert R.matching_statistics(np.frombuffer(data, np.uint8)).tolist() == longest_matches(data)


def removed(rows, length):
    """By (row): the spans, from counts of all windows."""
    texts = [(t or "").encode() for _, t in rows]
    found = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts):
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if found[t[p : p + length]] > 1:
                gone[p : p + length] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc_id, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(docs, length, **parameters):
    return sorted(map(tuple, R.digest(R.cut(docs, length=length, **parameters)).collect()), key=repr)


@pytest.mark.parametrize("group", [2000, 1])
def test_whole_table_against_brute_force(spark, group):
    docs = documents(spark, SF0001)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert result(docs, 400, group=group, block_bytes=20_000) == removed(rows, 400)


def test_short_lengths_periods_and_shared_ends(spark):
    rng = np.random.default_rng(8)
    core = "".join(rng.choice(list("abcdef "), 120).tolist())
    rows = [(1, "x" + core + "y"), (2, core[:60]), (3, "q" + core[30:] + "é" * 30), (4, "ab" * 100), (5, "é" * 40), (6, core)]
    for gram in (7, 20, 40):
        assert result(table(spark, rows), 40, gram=gram) == removed(rows, 40)


def test_awkward_rows(spark):
    docs = table(spark, clash=CLASHING)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert result(docs, 30, gram=10) == removed(rows, 30)
    assert R.cut(docs.limit(0)).count() == 0


def test_long_text_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(R, "_CHUNK", 1000)
    data = np.frombuffer(LONG.encode()[:20_000], np.uint8)
    items = list(R.select(data, R.Grams(20), 50))
    assert [first for first, _, _ in items] == [0, *np.cumsum([n for _, n, _ in items])[:-1]]
    assert sum(n for _, n, _ in items) == len(data) - 50 + 1


def test_remove_keeps_columns_and_drops_split_characters(spark):
    shared = "".join(chr(97 + i * i % 23) for i in range(60))
    rows = [(1, "é" + shared + "é"), (2, "è" + shared + "è")]  # the second byte differs, the first is shared
    kept = R.remove(table(spark, rows, clash=CLASHING), length=30, gram=10)
    assert kept.columns == ["doc_id", "text", *CLASHING]
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == {1: "é", 2: "è"}
    cut = [(1, "aé" + "x" * 40), (2, "bè" + "x" * 40)]
    out = {r["doc_id"]: r["text"] for r in R.remove(table(spark, cut), length=30, gram=10).collect()}
    assert out == {1: "aé", 2: "bè"}
    split = [(1, "p" * 29 + "é"), (2, "p" * 29 + "è")]  # a match ends inside a character
    out = {r["doc_id"]: r["text"] for r in R.remove(table(spark, split), length=30, gram=10).collect()}
    assert out == {1: "", 2: ""}
