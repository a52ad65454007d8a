"""Unigram counts against a dynamic program word by word."""

import math
import re

from conftest import SF0001
from helpers import CLASHING, table
from ledgerlens.llm import unigram_trie as U
from ledgerlens.llm.catalog import op6_unigram_trie
from ledgerlens.llm.common import documents

PIECES = U.Pieces(U.model_path())


def plain(word):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        cuts = [
            (best[s][0] + PIECES.scores[word[s:end]], -best[s][1] - 1)
            for s in range(max(0, end - PIECES.longest), end)
            if word[s:end] in PIECES.scores
        ]
        width = len(word[end - 1].encode())
        score, count = max(cuts) if cuts else (best[-1][0] + width * PIECES.byte, -best[-1][1] - width)
        best.append((score, -count))
    return best[-1]


def test_trie_shares_prefixes_and_agrees_word_by_word():
    words = sorted({"▁" + w for w in "a an and ant the then these 漢字 🙂x thththth zzzzzz ".split(" ")})
    counts, scores = U.count_sorted(words, PIECES)
    assert list(zip(scores, counts)) == [plain(w) for w in words]


def test_whole_table_and_awkward_rows(spark):
    for docs in (documents(spark, SF0001), table(spark, clash=CLASHING), table(spark).limit(0)):
        expected, known = [], {}
        for r in docs.select("doc_id", "text").collect():
            words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
            found = [known.setdefault(w, plain("▁" + w)) for w in words]
            expected.append((r["doc_id"], len(words), sum(c for _, c in found), sum(s for s, _ in found) + 0.0))
        assert sorted(map(tuple, U.count_tokens(docs).collect()), key=repr) == sorted(expected, key=repr)


def test_expected_uses_against_all_cuts():
    def cuts(word):
        if not word:
            yield ()
        for end in range(1, len(word) + 1):
            if word[:end] in PIECES.scores:
                yield from ((word[:end], *rest) for rest in cuts(word[end:]))

    flat = U.Pieces(U.model_path(), [-2.5] * (len(PIECES.scores) + 1))
    words, want = [("▁than", 3), ("▁the", 7), ("▁then", 2)], {}
    for word, n in words:
        weights = {cut: math.exp(-2.5 * len(cut)) for cut in cuts(word)}
        for cut, weight in weights.items():
            for piece in cut:
                want[piece] = want.get(piece, 0) + n * weight / sum(weights.values())
    got = {p: u / U.UNIT for p, u in zip(flat.scores, U.expected_uses(words, flat)) if u}
    assert got.keys() == {p for p, u in want.items() if u * U.UNIT > 1}
    assert all(abs(got[p] - want[p]) < 1e-3 for p in got)
    assert U.expected_uses([("▁𓀀", 5)], flat)[-1] == 5 * 4 * U.UNIT


def test_scores_are_probabilities_of_the_corpus(spark):
    docs = documents(spark, SF0001)
    scores = U.fit(docs)
    assert abs(sum(map(math.exp, scores[:-1])) + 256 * math.exp(scores[-1]) - 1) < 1e-6
    assert scores == U.fit(docs.repartition(5))
    fitted = U.Pieces(U.model_path(), scores)
    assert U.count_sorted(["▁the"], fitted)[0] == [1] and U.count_sorted(["▁the"], PIECES)[0] == [2]
    nothing = U.fit(docs.limit(0))
    assert len(nothing) == len(scores) and len(set(nothing)) == 1


def test_query_counts_a_common_word_once(spark, tmp_path):
    text = "the government of the people and the information of the international " * 50
    spark.createDataFrame([(1, text), (2, "the"), (3, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in op6_unigram_trie(spark, str(tmp_path)).collect()}
    assert got[1]["n_tokens"] == got[1]["n_words"] == 550
    assert got[2]["n_tokens"] == 1 and got[2]["score"] < 0 and got[3]["n_tokens"] == 0
