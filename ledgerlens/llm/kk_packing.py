"""Packing documents into token sequences by Karmarkar-Karp differencing.

A document's ids, then id 0, are cut into full sequences; what remains of it
is cut into pieces of at most ``MAX_PIECE`` ids.  The remaining pieces of a
pool of documents are divided among near-equal windows: multiway differencing
merges the two partial partitions with the largest imbalance, the fullest
window of one with the emptiest of the other, until one is left.  If a window
exceeds the capacity, the pool is divided anew among one window more.

Packing needs no shuffle: a pool never leaves its input partition, its size is
bounded by ``POOL_IDS``, and a lost task is simply run again.  Each partition
numbers its sequences in a range of its own.

Defined cases: a null or empty text is one id (the 0 at its end); repeated rows
are packed one by one; a null doc_id stays null; extra columns are not read; no
rows give no pieces.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import text_of
from ledgerlens.llm.tasks import map_task
from ledgerlens.llm.tokens import JoinedEncoder, blocks, encode_block, ranks_path

CAPACITY = 1024
MAX_PIECE = 192
POOL_IDS = 96 * CAPACITY
#: Sequences of one partition are numbered from its index times this.
SEQUENCES = 1 << 36
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long"
)


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Indices of ``sizes`` by window, near-equal in sum (Karmarkar-Karp, multiway).

    A partial partition is two arrays in order of the windows' sums: the sums,
    and what each window holds, a piece or a pair of earlier windows (-1: none).
    """
    if not sizes:
        return []
    heap, pairs, nodes = [], [], len(sizes)
    for i, size in enumerate(sizes):
        sums, held = np.zeros(windows, np.int64), np.full(windows, -1)
        sums[-1], held[-1] = size, i
        heap.append((-size if windows > 1 else 0, i, sums, held))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, other, also = heapq.heappop(heap)
        _, order, sums, held = heap[0]
        sums, also = sums + other[::-1], also[::-1]
        both = np.flatnonzero((held >= 0) & (also >= 0))
        merged = np.maximum(held, also)
        merged[both] = np.arange(nodes, nodes + len(both))
        pairs.append((nodes, held[both], also[both]))
        nodes += len(both)
        by = sums.argsort(kind="stable")
        sums = sums[by]
        heapq.heapreplace(heap, (int(sums[0] - sums[-1]), order, sums, merged[by]))
    window = np.empty(nodes, np.int64)
    held = heap[0][3]
    window[held[held >= 0]] = np.flatnonzero(held >= 0)
    for first, left, right in reversed(pairs):
        own = window[first : first + len(left)]
        window[left], window[right] = own, own
    found: list[list[int]] = [[] for _ in range(windows)]
    for i, w in enumerate(window[: len(sizes)].tolist()):
        found[w].append(i)
    return found


def pack_pool(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows of at most ``capacity``; one more window for as long as one is exceeded."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        packed = differencing(sizes, windows)
        if max((sum(sizes[i] for i in w) for w in packed), default=0) <= capacity:
            return [w for w in packed if w]
        windows += 1


def cuts(total: int, capacity: int, max_piece: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(start, length) of a document's full sequences, and of its remaining pieces, near-equal."""
    full = [(s, capacity) for s in range(0, total - total % capacity, capacity)]
    rest, begin = total % capacity, total - total % capacity
    n = -(-rest // max_piece)
    bounds = [begin + rest * i // n for i in range(n + 1)] if n else []
    return full, [(a, b - a) for a, b in zip(bounds, bounds[1:])]


def pack_batches(batches, path: str, capacity: int, max_piece: int, pool_ids: int) -> Iterator[pa.RecordBatch]:
    encode = JoinedEncoder(path)
    number = TaskContext.get().partitionId() * SEQUENCES
    out: list[tuple] = []
    pool: list[tuple] = []
    waiting = 0

    def close_pool():
        nonlocal number, waiting
        for window in pack_pool([piece[2] for piece in pool], capacity):
            offset = 0
            for i in sorted(window):
                out.append((*pool[i], number, offset))
                offset += pool[i][2]
            number += 1
        pool.clear()
        waiting = 0

    for batch in batches:
        for a, b in blocks(batch.column("text")):
            ids, ends = encode_block(batch.column("text").slice(a, b - a), encode)
            data, at = ids.astype("<u4", copy=False).tobytes(), 0
            for doc_id, end in zip(batch.column("doc_id").slice(a, b - a).to_pylist(), ends.tolist()):
                doc, at = data[4 * at : 4 * end] + b"\0\0\0\0", end
                total = len(doc) // 4
                full, rest = cuts(total, capacity, max_piece)
                for kind, pieces in ((True, full), (False, rest)):
                    for start, length in pieces:
                        crc = zlib.crc32(doc[4 * start : 4 * (start + length)])
                        piece = (doc_id, start, length, crc, total)
                        if kind:
                            out.append((*piece, number, 0))
                            number += 1
                        else:
                            pool.append(piece)
                            waiting += length
                if waiting >= pool_ids:
                    close_pool()
            if out:
                yield _batch(out)
                out.clear()
    if pool:
        close_pool()
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)


def pack(
    docs: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    max_piece: int = MAX_PIECE,
    pool_ids: int = POOL_IDS,
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    task = map_task(
        pack_batches, path=path or ranks_path(), capacity=capacity, max_piece=max_piece, pool_ids=pool_ids
    )
    return rows.mapInArrow(task, PIECES)
