"""Unigram token counts by dynamic programming over a trie of pre-tokens.

A pre-token is a word with the word mark before it.  The different pre-tokens
of a block of texts go into a trie; at each node the forward score, the best
sum of piece scores over all ways to cut the prefix, is computed once from the
scores of its ancestors, so pre-tokens with a common prefix share that work.
The token count of the best cut is stored where a pre-token ends.  Walking the
sorted pre-tokens visits the trie depth first; only the path to the current
node is held.

Scores: ``fit`` estimates the pieces' log-probabilities from all texts by
expectation maximisation, from equal ones on.  A pre-token's probability is the
sum over all ways to cut it, by the same program over prefixes; a piece's new
probability is its share of the expected uses.  The different pre-tokens and
their numbers are summed up once, and each round is a job over them.  Expected
uses are rounded per pre-token to whole units, so that sums, and with them all
scores, do not depend on partitions.  The pieces are those of a public
SentencePiece vocabulary, whose path is a parameter; its own scores are used
only where no others are given, and are log-probabilities only in a file of the
unigram kind.

A character that no piece covers costs its UTF-8 bytes, one byte piece each; the
256 byte pieces share their probability equally.  Of equal scores the cut with
fewer tokens wins, then the one with the longer last piece.

Defined cases: a null or empty text, or one of white space only, has no words
and no tokens; repeated rows are counted one by one; a null doc_id stays null;
extra columns are not read; no rows give no rows; without any word all pieces
keep equal scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from functools import cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import drop_scratch, scratch, text_of
from ledgerlens.llm.tasks import map_task
from ledgerlens.llm.tokens import blocks

MARK = "▁"
COUNTS = "doc_id long, n_words long, n_tokens long, score double"
ROUNDS = 2
#: Units of one use, to which expected uses are rounded.
UNIT = 1 << 16
#: Words share the work on prefixes up to this depth.
HELD = 4096


def model_path() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """Scores of a vocabulary's pieces, and of its byte pieces.

    ``scores`` has the pieces' scores in the order of the vocabulary, then that
    of a byte piece; without it they are the file's own.
    """

    def __init__(self, path: str, scores: Sequence[float] | None = None):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = range(model.get_piece_size())
        self.scores = {
            model.id_to_piece(i): model.get_score(i)
            for i in size
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        }
        # byte pieces carry no score of their own: each ranks behind every other piece
        self.byte = -float(len(self.scores))
        self.longest = max(map(len, self.scores))
        if scores is not None:
            self.scores, self.byte = dict(zip(self.scores, scores)), scores[-1]

    @cached_property
    def trie(self) -> dict:
        """The pieces by character: each maps to what may follow, and a piece's (place, score) or None."""
        root: dict[str, list] = {}
        for place, (piece, score) in enumerate(self.scores.items()):
            follow = root
            for char in piece:
                node = follow.setdefault(char, [{}, None])
                follow = node[0]
            node[1] = (place, score)
        return root


def shared_prefix(a: str, b: str) -> int:
    """Characters that two words begin with alike, as far as depths are held."""
    shared, most = 0, min(len(a), len(b), HELD)
    while shared < most and a[shared] == b[shared]:
        shared += 1
    return shared


def count_sorted(words: list[str], pieces: Pieces) -> tuple[list[int], list[float]]:
    """Tokens and score of the best cut of each word; ``words`` sorted, all different.

    With each depth go the pieces begun but not ended there, as places in the
    pieces' own trie: one step along it replaces looking up every possible last
    piece.
    """
    root, byte = pieces.trie, pieces.byte
    best, tokens = [0.0], [0]  # the path of the trie: forward score and count by depth
    begun: list[list] = [[]]
    before, counts, totals = "", [], []
    for word in words:
        shared = shared_prefix(before, word)
        del best[shared + 1 :], tokens[shared + 1 :], begun[shared + 1 :]
        live = begun[shared]
        for end in range(shared, len(word)):
            char, going, top, count = word[end], [], None, 0
            for start, follow in live:
                node = follow.get(char)
                if node is not None:
                    if node[0]:
                        going.append((start, node[0]))
                    if node[1] is not None:
                        score = node[1][1] + best[start]
                        if top is None or score > top or score == top and tokens[start] + 1 < count:
                            top, count = score, tokens[start] + 1
            node = root.get(char)
            if node is not None:
                if node[0]:
                    going.append((end, node[0]))
                if node[1] is not None:
                    score = node[1][1] + best[end]
                    if top is None or score > top or score == top and tokens[end] + 1 < count:
                        top, count = score, tokens[end] + 1
            if top is None:
                width = len(char.encode())
                top, count = best[end] + width * byte, tokens[end] + width
            best.append(top)
            tokens.append(count)
            live = going
            if end < HELD:
                begun.append(going)
        counts.append(tokens[-1])
        totals.append(best[-1])
        before = word
    return counts, totals


def expected_uses(words: Iterable[tuple[str, int]], pieces: Pieces) -> list[int]:
    """Units of expected uses of each piece, then of the bytes; ``words`` with their numbers.

    Sorted words share the work on their prefixes.
    """
    root, byte, n_pieces = pieces.trie, pieces.byte, len(pieces.scores)
    exp, log = math.exp, math.log
    uses = [0] * (n_pieces + 1)
    total = [0.0]  # the path of the trie: log of the summed probability by depth,
    shares: list = [None]  # each last piece's part of it,
    begun: list[list] = [[]]  # and the pieces begun but not ended
    before = ""
    for word, n in words:
        shared = shared_prefix(before, word)
        del total[shared + 1 :], shares[shared + 1 :], begun[shared + 1 :]
        live = begun[shared]
        for end in range(shared, len(word)):
            char, going, found = word[end], [], []
            for start, follow in live:
                node = follow.get(char)
                if node is not None:
                    if node[0]:
                        going.append((start, node[0]))
                    if node[1] is not None:
                        found.append((start, node[1][0], total[start] + node[1][1]))
            node = root.get(char)
            if node is not None:
                if node[0]:
                    going.append((end, node[0]))
                if node[1] is not None:
                    found.append((end, node[1][0], total[end] + node[1][1]))
            if len(found) > 1:
                top = max([x for _, _, x in found])
                whole = top + log(sum([exp(x - top) for _, _, x in found]))
                shares.append([(start, piece, exp(x - whole)) for start, piece, x in found])
            elif found:
                whole = found[0][2]
                shares.append([(found[0][0], found[0][1], 1.0)])
            else:
                whole = total[end] + len(char.encode()) * byte
                shares.append([(end, n_pieces, 1.0)])
            total.append(whole)
            live = going
            if end < HELD:
                begun.append(going)
        flow = [0.0] * len(word) + [float(n * UNIT)]
        for end in range(len(word), 0, -1):
            if not flow[end]:
                continue
            for start, piece, part in shares[end]:
                part *= flow[end]
                flow[start] += part
                uses[piece] += round(part) * (len(word[end - 1].encode()) if piece == n_pieces else 1)
        before = word
    return uses


def split_words(texts: pa.Array) -> pa.LargeListArray:
    return pc.split_pattern_regex(texts.cast(pa.large_string()), r"[\x20\x09-\x0D]+")


def word_batches(batches) -> Iterator[pa.RecordBatch]:
    """The different words of each block of texts, and how often they occur."""
    for batch in batches:
        for a, b in blocks(batch.column("text")):
            found = pc.value_counts(split_words(batch.column("text").slice(a, b - a)).flatten())
            found = found.filter(pc.not_equal(found.field("values"), ""))
            words = found.field("values").cast(pa.string())
            yield pa.RecordBatch.from_arrays([words, found.field("counts")], ["word", "n"])


def uses_batches(batches, path: str, scores: Sequence[float]) -> Iterator[pa.RecordBatch]:
    words = (
        (MARK + word, n)
        for batch in batches
        for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist())
    )
    uses = np.array(expected_uses(words, Pieces(path, scores)), np.int64)
    used = np.flatnonzero(uses)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(uses[used])], ["piece", "units"])


def fit(docs: DataFrame, path: str | None = None, rounds: int = ROUNDS) -> list[float]:
    """The pieces' log-probabilities over all texts, then that of a byte piece."""
    path = path or model_path()
    n_pieces = len(Pieces(path).scores)
    scores = [-math.log(n_pieces + 256)] * (n_pieces + 1)
    spark = docs.sparkSession
    words = docs.select(text_of().alias("text")).mapInArrow(map_task(word_batches), "word string, n long")
    words = words.groupBy("word").agg(F.sum("n").alias("n"))
    # in the order of the words, for long common prefixes
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = scratch(words.repartitionByRange(parts, "word").sortWithinPartitions("word"), "unigram_words")
    for _ in range(rounds):
        uses = words.mapInArrow(map_task(uses_batches, path=path, scores=scores), "piece int, units long")
        units = [1] * (n_pieces + 1)  # an unused piece counts as one unit, so that it keeps a score
        units[-1] = 256
        for piece, n in uses.groupBy("piece").agg(F.sum("units")).collect():  # one row a piece at most
            units[piece] += n
        whole = sum(units)
        units[-1] /= 256
        scores = [math.log(n / whole) for n in units]
    drop_scratch(words)
    return scores


def count_batches(batches, path: str, scores: Sequence[float] | None = None) -> Iterator[pa.RecordBatch]:
    pieces = Pieces(path, scores)
    for batch in batches:
        for a, b in blocks(batch.column("text")):
            words = split_words(batch.column("text").slice(a, b - a))
            offsets = words.offsets.to_numpy()
            coded = pc.dictionary_encode(words.flatten())
            index = coded.indices.to_numpy()
            names = coded.dictionary.to_numpy(zero_copy_only=False)
            order = sorted(range(len(names)), key=names.__getitem__)
            counts, totals = count_sorted([MARK + names[i] for i in order], pieces)
            count, score = np.zeros(len(names), np.int64), np.zeros(len(names))
            count[order], score[order] = counts, totals
            empty = names == ""
            count[empty], score[empty] = 0, 0.0
            first = offsets[:-1] - offsets[0]
            sums = [np.add.reduceat(x[index], first) for x in ((~empty).astype(np.int64), count, score)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, b - a), *map(pa.array, sums)],
                ["doc_id", "n_words", "n_tokens", "score"],
            )


def count_tokens(docs: DataFrame, path: str | None = None, scores: Sequence[float] | None = None) -> DataFrame:
    """Words, unigram tokens and the best cuts' score sum of every text; ``scores`` as ``fit`` gives them."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(map_task(count_batches, path=path or model_path(), scores=scores), COUNTS)
