"""Byte-level BPE by segment trees over adjacent pair ranks, and its decoding.

Each pre-token is a row of leaves, one per adjacent pair of symbols, holding
``rank * leaves + place`` of the pair's merge, or a large number if it has
none.  Inner nodes hold the least of their two children, so the root gives the
leftmost pair of the lowest rank.  A merge changes three leaves at most, and
each change climbs to the root; a pre-token is done when its root has no
merge.  Many pre-tokens of about the same length are merged at once: their
trees are rows of one numpy array, and every step is taken for all of them.

Defined cases: a null or empty text has no ids; a text that holds the special
token's string gives its id there; repeated rows are encoded one by one; a null
doc_id stays null; extra columns are not read; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import text_of
from ledgerlens.llm.tasks import map_task
from ledgerlens.llm.tokens import SPECIAL, SPECIAL_ID, blocks, encode_block, load_ranks, ranks_path, spread

NONE = np.int64(1) << 62
#: Pre-tokens merged at once hold about this many symbols together.
FOREST_SYMBOLS = 1 << 19
CODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PairRanks:
    """Rank and merged symbol of a pair of symbols, for arrays of pairs.

    A symbol is its token's id; a token's id is its rank.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 20 | right] = rank
        # open addressing: the table is at most a quarter full
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int64)
        for key, rank in pairs.items():
            at = int(self._slot(np.array([key]))[0])
            while self.keys[at] != -1:
                at = (at + 1) & (len(self.keys) - 1)
            self.keys[at], self.ranks[at] = key, rank

    def _slot(self, key: np.ndarray) -> np.ndarray:
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        at = self._slot(key)
        found = self.keys[at]
        rank = np.where(found == key, self.ranks[at], NONE)
        look = np.flatnonzero((found != key) & (found != -1))
        while len(look):
            at[look] = (at[look] + 1) & (len(self.keys) - 1)
            found = self.keys[at[look]]
            rank[look] = np.where(found == key[look], self.ranks[at[look]], NONE)
            look = look[(found != key[look]) & (found != -1)]
        return rank


def merge_forest(symbols: np.ndarray, sizes: np.ndarray, pair_ranks: PairRanks) -> np.ndarray:
    """Merge every row of ``symbols`` (rows of ``sizes`` symbols, then -1) in place.

    Symbols that a merge swallowed become -1.
    """
    rows, width = symbols.shape
    leaves = max(2, 1 << (max(1, width - 1) - 1).bit_length())
    places = np.arange(width)
    following = np.broadcast_to(places + 1, symbols.shape).copy()
    previous = np.broadcast_to(places - 1, symbols.shape).copy()
    following[places[None, :] + 1 >= sizes[:, None]] = -1
    tree = np.full((rows, 2 * leaves), NONE, np.int64)
    if width > 1:
        rank = pair_ranks(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(rows, width - 1)
        rank[places[None, 1:] >= sizes[:, None]] = NONE
        tree[:, leaves : leaves + width - 1] = np.where(rank < NONE, rank * leaves + places[: width - 1], NONE)
    level = leaves
    while level > 1:
        tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level //= 2

    symbols_, following_, previous_, tree_ = (x.reshape(-1) for x in (symbols, following, previous, tree))

    def put(row: np.ndarray, place: np.ndarray, value: np.ndarray) -> None:
        """Point update: set a leaf of some rows and climb to their roots."""
        base, node = row * (2 * leaves), place + leaves
        tree_[base + node] = value
        for _ in range(leaves.bit_length() - 1):
            sibling = tree_[base + (node ^ 1)]
            value = np.minimum(value, sibling)
            node = node >> 1
            tree_[base + node] = value

    live = np.flatnonzero(tree[:, 1] < NONE)
    while len(live):
        root = tree_[live * (2 * leaves) + 1]
        place, merged = root & (leaves - 1), root // leaves
        base = live * width
        right = following_[base + place]
        after = following_[base + right]
        symbols_[base + place] = merged
        symbols_[base + right] = -1
        following_[base + place] = after
        none = np.full(len(live), NONE)
        has = after >= 0
        previous_[base[has] + after[has]] = place[has]
        value = none.copy()
        rank = pair_ranks(merged[has], symbols_[base[has] + after[has]])
        value[has] = np.where(rank < NONE, rank * leaves + place[has], NONE)
        # the swallowed symbol's own pair first: its leaf is empty from now on
        inside = right < leaves
        put(live[inside], right[inside], none[inside])
        put(live, place, value)
        before = previous_[base + place]
        has = before >= 0
        rank = pair_ranks(symbols_[base[has] + before[has]], merged[has])
        put(live[has], before[has], np.where(rank < NONE, rank * leaves + before[has], NONE))
        live = live[tree_[live * (2 * leaves) + 1] < NONE]
    return symbols


class SegmentEncoder:
    """Encodes strings by pre-token; different pre-tokens of a call are merged once."""

    def __init__(self, path: str):
        self.ranks = load_ranks(path)
        self.pairs = PairRanks(self.ranks)
        self.split = regex.compile(public_tokenizers.PATTERN).findall

    def __call__(self, names: pa.Array, spaced: bool) -> tuple[np.ndarray, np.ndarray]:
        space = " " if spaced else ""
        pieces, counts = [], np.zeros(len(names), np.int64)
        for i, name in enumerate(names.to_numpy(zero_copy_only=False)):
            found = self.split(space + name)
            counts[i] = len(found)
            pieces += found
        number: dict[str, int] = {}
        index = np.array([number.setdefault(p, len(number)) for p in pieces], np.int64)
        ids, each = self.pieces([p.encode() for p in number])
        starts = np.cumsum(each) - each
        lengths = each[index]
        total = np.zeros(len(names), np.int64)
        np.add.at(total, np.repeat(np.arange(len(names)), counts), lengths)
        return ids[spread(starts[index], lengths)], total

    def pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pre-tokens, in order, and the number of each."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        kept = [np.zeros(0, np.uint32)]
        counts = np.zeros(len(pieces), np.int64)
        order = np.argsort(sizes, kind="stable")
        ordered = sizes[order]
        at = 0
        while at < len(order):
            # rows of similar length: a forest's leaves are those of its longest row
            width = 1 << max(0, int(ordered[at]) - 1).bit_length()
            stop = min(int(np.searchsorted(ordered, width, "right")), at + max(1, FOREST_SYMBOLS // width))
            chosen = order[at:stop]
            width = int(sizes[chosen[-1]])
            flat = np.frombuffer(b"".join(pieces[i] for i in chosen), np.uint8)
            mask = np.arange(width)[None, :] < sizes[chosen][:, None]
            symbols = np.full((len(chosen), width), -1, np.int64)
            symbols[mask] = self.pairs.byte[flat]
            merge_forest(symbols, sizes[chosen], self.pairs)
            left = symbols >= 0
            counts[chosen] = left.sum(axis=1)
            kept.append(symbols[left].astype(np.uint32))
            at = stop
        starts = np.zeros(len(pieces), np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        return np.concatenate(kept)[spread(starts, counts)], counts


class Decoder:
    """ids -> bytes; bytes that are no UTF-8 become replacement characters."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes = [b""] * (max(ranks.values()) + 2)
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.bytes[SPECIAL_ID] = SPECIAL.encode()

    def __call__(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


def code_batches(batches, path: str) -> Iterator[pa.RecordBatch]:
    encode = SegmentEncoder(path)
    decode = Decoder(encode.ranks)
    decimal = [str(i) for i in range(len(decode.bytes))]
    for batch in batches:
        for a, b in blocks(batch.column("text")):
            ids, ends = encode_block(batch.column("text").slice(a, b - a), encode)
            counts, coded, decoded, at = [], [], [], 0
            for end in ends.tolist():
                own, at = ids[at:end].tolist(), end
                counts.append(len(own))
                coded.append(hashlib.sha256(",".join(map(decimal.__getitem__, own)).encode()).hexdigest())
                decoded.append(hashlib.sha256(decode(own).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(a, b - a),
                    pa.array(counts, pa.int64()),
                    pa.array(coded, pa.string()),
                    pa.array(decoded, pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )


def code(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encode every text and decode the ids again: counts and digests per row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(map_task(code_batches, path=path or ranks_path()), CODED)
