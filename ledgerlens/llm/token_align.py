"""Cross-tokenizer alignment of two vocabularies over the same texts.

Vocabulary A (byte-level BPE) encodes a space and the text, vocabulary B
(pieces with byte fallback) the text, to which it adds that space.  Byte
offsets where tokens of both end cut a text into groups; tokens whose byte
ranges overlap are linked; an id pair counts the documents that hold it linked.

Method, whitespace-token anchors: both sides are tokenised in full; a shared
end before space-marked tokens of both (or at the text's end) closes a window of
token ids.  The different windows of a block, by their id tuples, are aligned
once and looked up for every other occurrence.  Equal windows are found by a
hash of their ids and then compared id by id.

At scale: a block (about ``BLOCK_BYTES`` of text) becomes one row: its
documents' figures, its different linked pairs with the number of documents
that hold each, and each document's pairs as numbers into that list, packed.
Only pairs are summed over the corpus; the sums return to their block by key,
once per block and pair however often it occurs.  Nothing is broadcast or
collected; texts are read once and never shuffled.

Defined cases: a null or empty text, and one whose joined token bytes on either
side differ from space and text (such as text with U+2581), have no tokens:
zeros and an empty hash column.  Strings of special tokens inside a text are
plain text.  Every row gets its own result, whatever its id, and counts as a
document; null ids stay null.  An empty table gives no rows.  Further columns of
the input play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import scratch, text_of
from ledgerlens.llm.tasks import cogroup_task, map_task
from ledgerlens.llm.tokens import SPECIAL, JoinedEncoder, encode_block, load_ranks, ranks_path, spread

PIECES = "piece_bpe_32k.model"
#: Bytes of text aligned at a time (one whole text at least).
BLOCK_BYTES = 3 << 20
#: Blocks of one task are numbered from its partition number times this.
BLOCKS = 1 << 33
#: An id pair as one number: A's id times this, plus B's.
SHIFT = 16

_NONE, _SPACE = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
FIGURES = ("n_a", "n_b", "n_groups", "n_links")
BLOCK_ROWS = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
    "n_links array<long>, sha array<string>, n_pairs array<long>, numbers binary, times binary, "
    "pairs array<long>, docs array<long>"
)
RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def pieces_path() -> str:
    return public_tokenizers.path(PIECES)


# ------------------------------------------------------------------ vocabularies


class PieceEncoder:
    """Ids of strings that begin with a space, which the model adds by itself.

    No piece holds a space mark after another character, so parts cut at single
    spaces have the ids they have in the whole text.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def bytes_of(self) -> list[bytes]:
        m, out = self.model, []
        for i in range(m.get_piece_size()):
            piece = m.id_to_piece(i)
            out.append(bytes([int(piece[3:5], 16)]) if m.is_byte(i) else piece.replace("▁", " ").encode())
        return out

    def __call__(self, names: pa.Array, spaced: bool) -> tuple[np.ndarray, np.ndarray]:
        """``spaced``: parts after a space; else whole strings with theirs, or empty ones."""
        texts = names.to_pylist()
        if not spaced:
            texts = [t[1:] if t else None for t in texts]
        each = iter(self.model.encode([t for t in texts if t is not None], num_threads=1))
        lists = [next(each) if t is not None else [] for t in texts]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(counts.sum()))
        return ids, counts


@dataclass
class Side:
    """One vocabulary: its encoder, and each id's bytes, byte count and space mark."""

    encode: object
    single: object
    raw: list[bytes]
    length: np.ndarray
    marked: np.ndarray


def _side(encode, single, raw: list[bytes]) -> Side:
    length = np.array([len(r) for r in raw], np.int64)
    return Side(encode, single, raw, length, np.array([r[:1] == b" " for r in raw]))


@lru_cache(maxsize=1)
def sides(path_a: str, path_b: str) -> tuple[Side, Side]:
    """Both vocabularies; a worker keeps them from task to task."""
    ranks = load_ranks(path_a)
    raw = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        raw[rank] = token
    joined, pieces = JoinedEncoder(path_a), PieceEncoder(path_b)

    def one(text: str) -> np.ndarray:
        return joined(pa.array([" " + text], pa.large_string()), False)[0].astype(np.int64)

    a = _side(joined, one, raw)
    b = _side(pieces, lambda text: np.array(pieces.model.encode(text), np.int64), pieces.bytes_of())
    return a, b


def encode_all(texts: pa.Array, side: Side) -> tuple[np.ndarray, np.ndarray]:
    """Ids of space and text for each text, and where each text's ids end."""
    special = pc.match_substring(texts, SPECIAL)
    plain = pc.if_else(special, _NONE, texts)
    ids, ends = encode_block(pc.binary_join_element_wise(_NONE, plain, _SPACE), side.encode)
    ids, ends = ids.astype(np.int64), np.asarray(ends)
    odd = np.flatnonzero(special.to_numpy(zero_copy_only=False))
    if len(odd):
        own = np.split(ids, ends[:-1])
        for i in odd:
            own[i] = side.single(texts[int(i)].as_py())
        ids, ends = np.concatenate(own), np.cumsum([len(x) for x in own])
    return ids, ends


def restored(ids: np.ndarray, ends: np.ndarray, side: Side, texts: list[bytes]) -> np.ndarray:
    """Whether each text's tokens join to a space and the text."""
    tokens, at, out = list(map(side.raw.__getitem__, ids.tolist())), 0, np.zeros(len(texts), bool)
    for i, (end, text) in enumerate(zip(ends.tolist(), texts)):
        out[i] = b"".join(tokens[at:end]) == b" " + text
        at = end
    return out


def only(ids: np.ndarray, ends: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the kept texts; the others get none."""
    counts = np.diff(ends, prepend=0)
    return ids[np.repeat(kept, counts)], np.cumsum(np.where(kept, counts, 0))


# ------------------------------------------------------------------ windows


@dataclass
class Windows:
    """Windows of a block: their id ranges on both sides, and where each text's windows end."""

    a: np.ndarray
    b: np.ndarray
    ends: np.ndarray


def _shared(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of A and of B that end at the same byte."""
    at = np.searchsorted(b_ends, a_ends)
    same = np.flatnonzero(b_ends[np.minimum(at, max(0, len(b_ends) - 1))] == a_ends) if len(b_ends) else at[:0]
    return same, at[same]


def windows_of(a_ids, a_stops, b_ids, b_stops, a: Side, b: Side) -> Windows:
    """Cut at shared ends that come before space-marked tokens of both sides, and at texts' ends."""
    i, j = _shared(np.cumsum(a.length[a_ids]), np.cumsum(b.length[b_ids]))
    marked_a = np.append(a.marked[a_ids[1:]], True)
    marked_b = np.append(b.marked[b_ids[1:]], True)
    last = np.zeros(len(a_ids), bool)
    last[a_stops[np.diff(a_stops, prepend=0) > 0] - 1] = True
    anchor = (marked_a[i] & marked_b[j]) | last[i]
    stops = np.searchsorted(i[anchor] + 1, a_stops, "right")
    return Windows(np.append(0, i[anchor] + 1), np.append(0, j[anchor] + 1), stops)


_PRIME = 0x9E3779B97F4A7C15


def _hashes(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each range of ids that does not depend on where it lies."""
    power = np.cumprod(np.full(len(ids) + 1, _PRIME, np.uint64))
    inverse = np.cumprod(np.full(len(ids) + 1, pow(_PRIME, -1, 1 << 64), np.uint64))
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    sums = np.append(np.zeros(1, np.uint64), np.cumsum(mixed * power[:-1]))
    return (sums[bounds[1:]] - sums[bounds[:-1]]) * inverse[bounds[:-1]]


def distinct(w: Windows, a_ids: np.ndarray, b_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One window of each id tuple, and for every window the place of its own in that list."""
    key = _hashes(a_ids, w.a) * np.uint64(0xC2B2AE3D27D4EB4F) + _hashes(b_ids, w.b)
    _, chosen, place = np.unique(key, return_index=True, return_inverse=True)
    wrong = np.zeros(len(place), bool)
    for ids, bounds in ((a_ids, w.a), (b_ids, w.b)):
        size, own = np.diff(bounds), chosen[place]
        wrong |= size != size[own]
        size = np.where(wrong, 0, size)
        mine, theirs = ids[spread(bounds[:-1], size)], ids[spread(bounds[:-1][own], size)]
        wrong[np.repeat(np.arange(len(size)), size)[mine != theirs]] = True
    if wrong.any():  # a hash shared by other ids: those windows stand for themselves
        odd = np.flatnonzero(wrong)
        place[odd] = len(chosen) + np.arange(len(odd))
        chosen = np.append(chosen, odd)
    return chosen, place


@dataclass
class Alignment:
    """Groups and links of the different windows of a block."""

    groups: pa.Array
    n_groups: np.ndarray
    pairs: np.ndarray
    link_ends: np.ndarray


def _texts_of_ids(side: Side) -> pa.Array:
    """Each id followed by a comma, then each id followed by a bar, then by a semicolon."""
    ids = [str(i) for i in range(len(side.raw))]
    return pa.array([i + end for end in ",|;" for i in ids], pa.large_string())


def align(chosen: np.ndarray, w: Windows, a_ids, b_ids, a: Side, b: Side, names) -> Alignment:
    """Each different window: its groups as text, and its links as pair numbers."""
    sizes_a, sizes_b = np.diff(w.a)[chosen], np.diff(w.b)[chosen]
    x, y = a_ids[spread(w.a[:-1][chosen], sizes_a)], b_ids[spread(w.b[:-1][chosen], sizes_b)]
    x_end, y_end = np.cumsum(a.length[x]), np.cumsum(b.length[y])
    x_from, y_from = x_end - a.length[x], y_end - b.length[y]

    low = np.searchsorted(y_end, x_from, "right")
    high = np.searchsorted(y_from, x_end, "left")
    links = y[spread(low, high - low)]
    pairs = (np.repeat(x, high - low) << SHIFT) + links
    window_ends = np.cumsum(sizes_a)
    link_ends = np.append(0, np.cumsum(high - low))[window_ends]

    i, j = _shared(x_end, y_end)
    group_a, group_b = np.append(0, i + 1), np.append(0, j + 1)
    n_groups = np.diff(np.searchsorted(i + 1, window_ends, "right"), prepend=0)
    # A's ids of a group, then B's; an id's text ends as its place in the group asks.
    order_a = np.arange(len(x)) + np.repeat(group_b[:-1], np.diff(group_a))
    order_b = np.arange(len(y)) + np.repeat(group_a[1:], np.diff(group_b))
    size_a, size_b = len(a.raw), len(b.raw)
    code = np.empty(len(x) + len(y), np.int64)
    last_a, last_b = np.zeros(len(x), bool), np.zeros(len(y), bool)
    last_a[i], last_b[j] = True, True
    code[order_a] = x + size_a * last_a
    code[order_b] = 3 * size_a + y + 2 * size_b * last_b
    ends = np.append(0, window_ends + np.cumsum(sizes_b))
    texts = pa.LargeListArray.from_arrays(pa.array(ends), names.take(pa.array(code)))
    return Alignment(pc.binary_join(texts, _NONE), n_groups, pairs, link_ends)


# ------------------------------------------------------------------ blocks


@dataclass
class Block:
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[bytes]
    pairs: np.ndarray  # the block's different pairs
    docs: np.ndarray  # documents that hold each
    owner: np.ndarray  # of each (document, pair): the document,
    number: np.ndarray  # the pair's place in ``pairs``
    times: np.ndarray  # and how often it is linked


def align_block(texts: pa.Array, a: Side, b: Side, names: pa.Array) -> Block:
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    raw = texts.cast(pa.large_binary()).to_pylist()
    (a_ids, a_stops), (b_ids, b_stops) = encode_all(texts, a), encode_all(texts, b)
    kept = restored(a_ids, a_stops, a, raw) & restored(b_ids, b_stops, b, raw)
    kept &= np.array([len(r) > 0 for r in raw], bool)
    if not kept.all():
        (a_ids, a_stops), (b_ids, b_stops) = only(a_ids, a_stops, kept), only(b_ids, b_stops, kept)
    n = len(raw)
    w = windows_of(a_ids, a_stops, b_ids, b_stops, a, b)
    chosen, place = distinct(w, a_ids, b_ids)
    own = align(chosen, w, a_ids, b_ids, a, b, names)

    bounds = np.append(0, w.ends)
    texts_of = pa.LargeListArray.from_arrays(pa.array(bounds), own.groups.take(pa.array(place)))
    groups = [g[:-1] for g in pc.binary_join(texts_of, _NONE).cast(pa.large_binary()).to_pylist()]
    sums = np.append(0, np.cumsum(own.n_groups[place]))
    n_groups = np.diff(sums[bounds])

    pairs, coded = np.unique(own.pairs, return_inverse=True)
    start, count = np.append(0, own.link_ends)[:-1], np.diff(own.link_ends, prepend=0)
    linked = coded[spread(start[place], count[place])]
    sums = np.append(0, np.cumsum(count[place]))
    n_links = np.diff(sums[bounds])
    held, times = np.unique(np.repeat(np.arange(n), n_links) * max(1, len(pairs)) + linked, return_counts=True)
    owner, number = np.divmod(held, max(1, len(pairs)))
    docs = np.bincount(number, minlength=len(pairs))
    return Block(
        np.diff(a_stops, prepend=0), np.diff(b_stops, prepend=0), n_groups, n_links, groups,
        pairs, docs, owner, number, times,
    )


def blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``BLOCK_BYTES``."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + BLOCK_BYTES, "right")))
        yield start, stop
        start = stop


def _aligned(batches, path_a: str, path_b: str) -> Iterator[tuple[list, Block]]:
    a, b = sides(path_a, path_b)
    names = pa.concat_arrays([_texts_of_ids(a), _texts_of_ids(b)])
    for rows in _gathered(batches):
        yield rows.column("doc_id").to_pylist(), align_block(rows.column("text"), a, b, names)


def _gathered(batches) -> Iterator[pa.RecordBatch]:
    """Batches joined and cut to blocks: fewer blocks repeat fewer pairs."""
    held, size = [], 0
    for batch in batches:
        for start, stop in blocks(batch.column("text")):
            part = batch.slice(start, stop - start)
            own = pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
            if held and size + own > BLOCK_BYTES:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
            held.append(part)
            size += own
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.astype("<u4").tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 4 * n, codec="zstd", asbytes=True), "<u4").astype(np.int64)


def block_batches(batches, path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    """One row per block (``BLOCK_ROWS``)."""
    number = TaskContext.get().partitionId() * BLOCKS
    for doc_ids, own in _aligned(batches, path_a, path_b):
        n_pairs = np.bincount(own.owner, minlength=len(doc_ids))
        # Pair numbers as steps within each document, which pack better.
        step = np.diff(own.number, prepend=0)
        firsts = (np.cumsum(n_pairs) - n_pairs)[n_pairs > 0]
        step[firsts] = own.number[firsts]
        row = {
            "block": [number],
            "doc_ids": [doc_ids],
            **{name: [getattr(own, name).tolist()] for name in FIGURES},
            "sha": [[hashlib.sha256(g).hexdigest() if n else "" for g, n in zip(own.groups, own.n_groups)]],
            "n_pairs": [n_pairs.tolist()],
            "numbers": [_packed(step)],
            "times": [_packed(own.times)],
            "pairs": [own.pairs.tolist()],
            "docs": [own.docs.tolist()],
        }
        yield pa.RecordBatch.from_pydict(row, _BLOCK_ARROW)
        number += 1


_LONGS = pa.list_(pa.int64())
_BLOCK_ARROW = pa.schema(
    [("block", pa.int64()), ("doc_ids", _LONGS), *[(n, _LONGS) for n in FIGURES], ("sha", pa.list_(pa.string()))]
    + [("n_pairs", _LONGS), ("numbers", pa.binary()), ("times", pa.binary()), ("pairs", _LONGS), ("docs", _LONGS)]
)


def count_batches(key, block: pa.Table, counts: pa.Table) -> pa.Table:
    """A block's documents with their sums over the corpus counts of its pairs."""
    out = []
    for row in block.to_pylist():
        count, best = np.zeros(counts.num_rows, np.int64), np.zeros(counts.num_rows, np.int64)
        place = counts["place"].to_numpy()
        count[place], best[place] = counts["n"].to_numpy(), counts["best"].to_numpy().astype(np.int64)
        n_pairs = np.array(row["n_pairs"], np.int64)
        total = int(n_pairs.sum())
        times, steps = _unpacked(row["times"], total), _unpacked(row["numbers"], total)
        sums = np.append(0, np.cumsum(steps))
        starts = np.cumsum(n_pairs) - n_pairs
        number = sums[1:] - np.repeat(sums[starts], n_pairs)
        ends = np.append(0, np.cumsum(n_pairs))
        sum_count = np.diff(np.append(0, np.cumsum(times * count[number]))[ends])
        sum_best = np.diff(np.append(0, np.cumsum(times * best[number]))[ends])
        columns = [row["doc_ids"], *[row[n] for n in FIGURES], sum_best.tolist(), sum_count.tolist(), row["sha"]]
        out.append(pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, _RESULT_ARROW.types)], schema=_RESULT_ARROW))
    return pa.concat_tables(out) if out else _RESULT_ARROW.empty_table()


_RESULT_ARROW = pa.schema(
    [("doc_id", pa.int64()), *[(n, pa.int64()) for n in FIGURES]]
    + [("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())]
)


def group_batches(batches, path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    for doc_ids, own in _aligned(batches, path_a, path_b):
        groups = pa.array([g.decode() for g in own.groups], pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), groups], ["doc_id", "groups"])


# ------------------------------------------------------------------ frames


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))


def groups(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Each document's groups: ``a1,a2|b1;a3|b2,b3``, ids in order."""
    task = map_task(group_batches, path_a=path_a or ranks_path(), path_b=path_b or pieces_path())
    return _rows(docs).mapInArrow(task, "doc_id long, groups string")


def align_blocks(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """The aligned blocks, written once."""
    task = map_task(block_batches, path_a=path_a or ranks_path(), path_b=path_b or pieces_path())
    return scratch(_rows(docs).mapInArrow(task, BLOCK_ROWS), "aligned-blocks")


def block_pairs(blocks_: DataFrame) -> DataFrame:
    """``block, place, pair, docs``: the pairs of each block and its documents that hold them."""
    each = F.posexplode(F.arrays_zip("pairs", "docs"))
    rows = blocks_.select("block", each.alias("place", "p"))
    return rows.select("block", "place", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``pair, a, b, n, best``: documents that hold a pair, and whether no pair of its A id has more."""
    sums = pairs.groupBy("pair").agg(F.sum("docs").alias("n"))
    sums = sums.withColumns({"a": F.shiftright("pair", SHIFT), "b": F.col("pair") % (1 << SHIFT)})
    most = sums.groupBy("a").agg(F.max("n").alias("most"))
    return sums.join(most, "a").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def links(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """The linked id pairs of the corpus: ``a, b, n`` documents, ``best``."""
    return pair_counts(block_pairs(align_blocks(docs, path_a, path_b))).drop("pair")


def aligned(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per document: tokens, groups, links and what the corpus says of its links."""
    done = align_blocks(docs, path_a, path_b)
    pairs = block_pairs(done)
    counts = scratch(pair_counts(pairs).select("pair", "n", "best"), "pair-counts")
    back = pairs.join(counts, "pair").select(
        F.col("block").alias("of"), F.col("place").cast("long").alias("place"), "n", "best"
    )
    own = done.drop("pairs", "docs")
    return own.groupBy("block").cogroup(back.groupBy("of")).applyInArrow(cogroup_task(count_batches), RESULT)
