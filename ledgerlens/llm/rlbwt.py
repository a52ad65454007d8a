"""Repeated passages by a run-length compressed Burrows-Wheeler transform.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere
else in the corpus.  One index of the whole corpus would be one task, so the
strings are first dealt out by content:

1. Winnowing.  Every window of ``LENGTH`` bytes selects the least hash among its
   ``GRAM``-byte grams.  Equal windows select equal grams at the same place, so
   a window can only be repeated if its gram is.  Neighbouring windows with the
   same gram are one item; the item's context is all bytes of its windows.
2. Classes.  Items are counted by gram and by 128-bit hash of the context.  A
   context found twice is repeated as a whole.  A gram found once is no match.
3. Index.  What is left - different contexts around the same gram - is cut out
   of the texts and dealt into blocks, all contexts of a gram into one.  A block
   sorts its suffixes, run-length compresses its Burrows-Wheeler transform, and
   takes samples at the ends of the runs: how far the suffix there matches its
   neighbour in suffix order.  Streaming over the block, the longest match of
   each position is that of the position before less one, or the sample's if
   one lies there; the transform's runs say that no other value can occur.
   Positions that match ``LENGTH`` bytes or more are marked.

A gram with more than ``GROUP`` different contexts would make one block too
large.  Its windows are hashed one by one instead and counted by hash, spread
over all tasks.

Contexts (step 2) and windows of crowded grams are equal if their 128-bit
hashes are; their bytes are not compared again.  Among n different ones two
share a hash with a probability below n * n / 2**129: one in 10 ** 14 for the
10 ** 12 contexts of 100 TB.

Defined cases: a null or empty text, or one shorter than ``LENGTH`` bytes, keeps
all its bytes; repeated rows are repeats of each other; a null doc_id stays
null; removal may split a character, whose rest ``remove`` drops and ``cut`` keeps;
extra columns pass through ``remove``; no rows give
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import drop_scratch, join_counted, keyed, release_shuffles, same_row, scratch, text_of, utf8
from ledgerlens.llm.tasks import group_task, map_task

LENGTH, GRAM = 400, 160
GROUP = 2000
BLOCK_BYTES = 600_000
SALTS = 16
#: Texts cut at a time.
CUT_ROWS = 500
SEPARATOR = 0xFF  # in no UTF-8 text

ITEMS = "doc_id long, rk long, first int, windows int, gram long, c1 long, c2 long"
CONTEXTS = "doc_id long, rk long, first int, windows int, gram long, open boolean, crowded boolean, context binary"
WINDOWS = "doc_id long, rk long, first int, open boolean, h1 long, h2 long"
SPANS = "doc_id long, rk long, first int, last int"


# --- winnowing ----------------------------------------------------------------

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_CHUNK = 1 << 18


class Grams:
    """Rolling hashes of all grams of a text, from prefix sums of weighted bytes."""

    def __init__(self, gram: int):
        self.gram = gram
        size = _CHUNK + 2 * LENGTH
        self.power, self.inverse = (
            np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, base, np.uint64))])
            for base in (_BASE, pow(_BASE, -1, 1 << 64))
        )
        weights = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
        self.weight = weights ^ (weights >> np.uint64(31))

    def __call__(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.weight[data] * self.power[:n], out=sums[1:])
        h = (sums[self.gram :] - sums[: n + 1 - self.gram]) * self.inverse[: n + 1 - self.gram]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(32))


def select(data: np.ndarray, grams: Grams, length: int) -> Iterator[tuple[int, int, int]]:
    """(first window, windows, gram hash) of each item of a text.

    Long texts are taken in chunks that overlap by a window; a window's choice
    depends on its own bytes alone, so chunks change nothing but where an item
    may be cut in two.
    """
    width = length - grams.gram + 1
    low = np.uint64((1 << 20) - 1)
    for begin in range(0, len(data) - length + 1, _CHUNK):
        part = data[begin : begin + _CHUNK + length - 1]
        h = grams(part)
        n = len(part) - length + 1
        # the leftmost least hash: places in the low bits break ties
        ranked = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        padded = np.concatenate([ranked, np.full(-len(ranked) % width, np.uint64(_MASK))]).reshape(-1, width)
        ahead = np.minimum.accumulate(padded, axis=1).ravel()
        behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        place = (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & low).astype(np.int64)
        firsts = np.flatnonzero(np.diff(place, prepend=-1))
        counts = np.diff(firsts, append=n)
        for first, count, value in zip(firsts.tolist(), counts.tolist(), h[place[firsts]].tolist()):
            yield begin + first, count, value


def item_batches(batches, length: int, gram: int) -> Iterator[pa.RecordBatch]:
    from xxhash import xxh3_128_digest

    grams = Grams(gram)
    for batch in batches:
        ids, keys = batch.column("doc_id").to_pylist(), batch.column("rk").to_pylist()
        rows, firsts, counts, values, marks = [], [], [], [], []
        for i, text in enumerate(utf8(batch.column("text"))):
            for first, count, value in select(np.frombuffer(text, np.uint8), grams, length):
                rows.append(i)
                firsts.append(first)
                counts.append(count)
                values.append(value)
                marks.append(xxh3_128_digest(text[first : first + count + length - 1]))
            if len(rows) > 100_000:
                yield _items(ids, keys, rows, firsts, counts, values, marks)
                rows, firsts, counts, values, marks = [], [], [], [], []
        yield _items(ids, keys, rows, firsts, counts, values, marks)


def _items(ids, keys, rows, firsts, counts, values, marks) -> pa.RecordBatch:
    words = np.frombuffer(b"".join(marks), "<i8").reshape(-1, 2)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([ids[i] for i in rows], pa.int64()),
            pa.array([keys[i] for i in rows], pa.int64()),
            pa.array(firsts, pa.int32()),
            pa.array(counts, pa.int32()),
            pa.array(np.array(values, np.uint64).view(np.int64)),
            pa.array(np.ascontiguousarray(words[:, 0])),
            pa.array(np.ascontiguousarray(words[:, 1])),
        ],
        ["doc_id", "rk", "first", "windows", "gram", "c1", "c2"],
    )


# --- the index of a block -------------------------------------------------------


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start places of all suffixes in order (prefix doubling from eight bytes on).

    Each round sorts only suffixes that still share their group.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = key << np.uint64(8) | padded[i : i + n]
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    rank = np.zeros(n + 1, np.int64)  # a suffix beyond the end comes first
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(1, n + 1), 0))
    active = np.arange(n)
    shift = 8
    while True:
        last = np.concatenate([fresh[1:], [True]])
        still = ~(fresh & last)
        active, idx = active[still], order[active[still]]
        if not len(active) or shift >= n:
            return order
        joint = rank[idx] << np.int64(32) | rank[np.minimum(idx + shift, n)]
        by = np.argsort(joint, kind="stable")
        idx, joint = idx[by], joint[by]
        order[active] = idx
        fresh = np.concatenate([[True], joint[1:] != joint[:-1]])
        rank[idx] = np.maximum.accumulate(np.where(fresh, active + 1, 0))
        shift *= 2


def match_lengths(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bytes the suffixes at places ``a`` and ``b`` share."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)[:n].copy().view(">u8").ravel()
    # sentinels: past the end nothing is equal
    length = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    while len(live):
        x, y = a[live] + length[live], b[live] + length[live]
        inside = np.maximum(x, y) + 8 <= n
        equal = inside.copy()
        equal[inside] = words[x[inside]] == words[y[inside]]
        length[live[equal]] += 8
        live = live[equal]
    for _ in range(8):
        x, y = a + length, b + length
        inside = np.maximum(x, y) < n
        inside[inside] = text[x[inside]] == text[y[inside]]
        if not inside.any():
            break
        length[inside] += 1
    return length


def matching_statistics(text: np.ndarray) -> np.ndarray:
    """The longest match of each position with any other, from the runs of the transform."""
    n = len(text)
    if n < 2:
        return np.zeros(n, np.int64)
    order = suffix_order(text)
    transform = text[order - 1].astype(np.int64)  # the byte before each suffix
    transform[order == 0] = -1
    # ends of runs: a suffix and its neighbour follow different bytes
    ends = np.flatnonzero(transform[1:] != transform[:-1])
    above, below = order[ends], order[ends + 1]
    lengths = match_lengths(text, above, below)
    reach = np.zeros(n, np.int64)  # a sample's place plus its match length
    np.maximum.at(reach, above, above + lengths)
    np.maximum.at(reach, below, below + lengths)
    return np.maximum(np.maximum.accumulate(reach) - np.arange(n), 0)


def index_block(key, table: pa.Table, length: int) -> pa.Table:
    """Spans of the open contexts' windows that occur again in the block."""
    contexts = table.column("context").to_pylist()
    text = np.frombuffer(b"".join(c + bytes([SEPARATOR]) for c in contexts), np.uint8)
    repeated = matching_statistics(text) >= length
    begins = np.cumsum([0] + [len(c) + 1 for c in contexts])
    found = {"doc_id": [], "rk": [], "first": [], "last": []}
    columns = [table.column(c).to_pylist() for c in ("doc_id", "rk", "first", "windows", "open")]
    for begin, doc_id, rk, first, windows, is_open in zip(begins.tolist(), *columns):
        if not is_open:
            continue
        marks = np.diff(repeated[begin : begin + windows].astype(np.int8), prepend=0, append=0)
        for a, b in zip(np.flatnonzero(marks == 1).tolist(), np.flatnonzero(marks == -1).tolist()):
            for name, value in zip(found, (doc_id, rk, first + a, first + b - 1)):
                found[name].append(value)
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.table({n: pa.array(v, kind) for (n, v), kind in zip(found.items(), kinds)})


# --- cutting contexts and windows out of the texts -------------------------------


def context_batches(batches, length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = batch.column("doc_id").to_pylist(), batch.column("rk").to_pylist()
        wanted = batch.column("wanted").to_pylist()
        rows, size = [], 0
        for doc_id, rk, text, items in zip(ids, keys, utf8(batch.column("text")), wanted):
            for w in items:
                context = text[w["first"] : w["first"] + w["windows"] + length - 1]
                rows.append((doc_id, rk, w["first"], w["windows"], w["gram"], w["open"], w["crowded"], context))
                size += len(context)
            if size > 8 << 20:
                yield _contexts(rows)
                rows, size = [], 0
        yield _contexts(rows)


def _contexts(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary())
    names = ["doc_id", "rk", "first", "windows", "gram", "open", "crowded", "context"]
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def window_batches(batches, length: int) -> Iterator[pa.RecordBatch]:
    """One row per window of a context: its 128-bit hash."""
    from xxhash import xxh3_128_digest

    for batch in batches:
        table = pa.Table.from_batches([batch])
        for start in range(0, len(table), 200):
            part = table.slice(start, 200)
            contexts, counts = part.column("context").to_pylist(), part.column("windows").to_pylist()
            index = np.repeat(np.arange(len(part)), counts)
            marks = b"".join(
                xxh3_128_digest(c[i : i + length]) for c, n in zip(contexts, counts) for i in range(n)
            )
            words = np.frombuffer(marks, "<i8").reshape(-1, 2)
            offset = np.concatenate([np.arange(n) for n in counts]) if counts else np.zeros(0, np.int64)
            taken = part.select(["doc_id", "rk", "first", "open"]).take(pa.array(index)).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [
                    taken.column("doc_id").combine_chunks(),
                    taken.column("rk").combine_chunks(),
                    pa.array((taken.column("first").to_numpy() + offset).astype(np.int32)),
                    taken.column("open").combine_chunks(),
                    pa.array(np.ascontiguousarray(words[:, 0])),
                    pa.array(np.ascontiguousarray(words[:, 1])),
                ],
                ["doc_id", "rk", "first", "open", "h1", "h2"],
            )


# --- the operator ---------------------------------------------------------------


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, rk, first, last``: runs of windows (by first byte) that occur elsewhere."""
    spark = docs.sparkSession
    rows = keyed(docs)
    every = scratch(rows.mapInArrow(map_task(item_batches, length=length, gram=gram), ITEMS), "items")
    # few grams are found twice; each is there once per salt, so that one with very many items meets several tasks
    salts = F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)]))
    salt = F.pmod("c1", F.lit(SALTS))
    twice = every.groupBy("gram").agg(F.count("*").alias("found")).where("found > 1")
    items = every.withColumn("salt", salt).join(twice.select("gram", salts.alias("salt")), ["gram", "salt"], "left_semi")
    items = scratch(items.drop("salt"), "repeated")
    drop_scratch(every)
    release_shuffles(spark)
    cls = ["gram", "c1", "c2"]
    classes = items.groupBy(cls).agg(
        F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("doc_id", "rk", "first", "windows")]
    )
    grams = classes.groupBy("gram").agg(F.count("*").alias("contexts")).select("gram", "contexts", salts.alias("salt"))
    placed = scratch(classes.withColumn("salt", salt).join(grams, ["gram", "salt"]).drop("salt"), "classes")
    release_shuffles(spark)

    copied = placed.where("n > 1").select(*cls, "n")
    total = copied.agg(F.sum("n")).first()[0] or 0
    whole = join_counted(items, copied, cls, "n", total, "left_semi").select(
        "doc_id", "rk", "first", (F.col("first") + F.col("windows") - 1).alias("last")
    )
    wanted = placed.where("contexts > 1").select(
        "doc_id", "rk",
        F.struct("first", "windows", "gram", (F.col("n") == 1).alias("open"), (F.col("contexts") > group).alias("crowded")).alias("item"),
    )
    whole = scratch(whole, "whole")
    per_text = wanted.groupBy("doc_id", "rk").agg(F.collect_list("item").alias("wanted"))
    drop_scratch(items)
    release_shuffles(spark)

    cut_out = (
        rows.join(per_text, same_row(rows, per_text))
        .select(rows["doc_id"], rows["rk"], "text", "wanted")
        .dropDuplicates(["doc_id", "rk"])
    )
    context = scratch(cut_out.mapInArrow(map_task(context_batches, length=length), CONTEXTS), "contexts")
    release_shuffles(spark)
    few = context.where("not crowded")
    size = few.agg(F.sum(F.length("context"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    # a number of its own: blocks are small in bytes and long in work, and are not to be coalesced
    tasks = min(blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    indexed = (
        few.drop("crowded")
        .withColumn("block", F.pmod(F.xxhash64("gram"), F.lit(blocks)))
        .repartition(tasks, "block")
        .groupBy("block")
        .applyInArrow(group_task(index_block, length=length), SPANS)
    )
    windows = context.where("crowded").select("doc_id", "rk", "first", "windows", "open", "context").mapInArrow(
        map_task(window_batches, length=length), WINDOWS
    )
    at = ["h1", "h2"]
    several = windows.groupBy(at).agg(F.count("*").alias("n")).where("n > 1").select(at)
    hashed = windows.where("open").join(several, at, "left_semi").select(
        "doc_id", "rk", "first", F.col("first").alias("last")
    )
    return whole.unionByName(scratch(indexed.unionByName(hashed), "spans"))


def removed_runs(spans: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Maximal runs of removed bytes (from, to) of one text."""
    runs: list[tuple[int, int]] = []
    for first, last in sorted((s["first"], s["last"] + length) for s in spans or ()):
        if runs and first <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(last, runs[-1][1]))
        else:
            runs.append((first, last))
    return runs


def _kept(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    bounds = [0, *(x for run in runs for x in run), len(text)]
    return b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2]))


def cut_batches(batches, length: int, as_text: bool, least_words: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, len(whole), CUT_ROWS):
            batch = whole.slice(start, CUT_ROWS)
            texts = utf8(batch.column("text"))
            runs = [removed_runs(s, length) for s in batch.column("spans").to_pylist()]
            if least_words:
                runs = [[(a, b) for a, b in r if len(t[a:b].split()) >= least_words] for t, r in zip(texts, runs)]
            kept = [_kept(t, r) for t, r in zip(texts, runs)]
            kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array([[{"from": a, "to": b} for a, b in r] for r in runs], kind),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([k.decode(errors="ignore") for k in kept]) if as_text else pa.array(kept, pa.binary()),
                ],
                ["row", "removed", "n_bytes", "kept"],
            )


def cut(
    docs: DataFrame, length: int = LENGTH, as_text: bool = False, least_words: int = 0, **parameters
) -> DataFrame:
    """``row`` (the columns as given, but the text), ``removed`` runs, ``n_bytes`` and what is ``kept``.

    ``kept`` are bytes; as text, without the rest of a character that was cut in two.
    Runs of fewer words than ``least_words`` (at white space) stay.
    """
    spans = repeats(docs, length, **parameters)
    per_text = spans.groupBy("doc_id", "rk").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    others = [c for c in docs.columns if c.lower() != "text"]
    rows = docs.select(
        F.struct(*[docs[c] for c in others]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text_of()).alias("rk"),
        text_of().alias("text"),
    )
    met = rows.join(per_text, same_row(rows, per_text), "left").select("row", "text", "spans")
    row_type = met.schema["row"].dataType.simpleString()
    schema = f"row {row_type}, removed array<struct<`from`:bigint,`to`:bigint>>, n_bytes bigint, kept {'string' if as_text else 'binary'}"
    return met.mapInArrow(map_task(cut_batches, length=length, as_text=as_text, least_words=least_words), schema)


def remove(docs: DataFrame, **parameters) -> DataFrame:
    """The rows with their texts cut; all columns as given.  A character cut in two goes."""
    done = cut(docs, as_text=True, **parameters)
    columns = [F.col("kept").alias(c) if c.lower() == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    return done.select(*columns)


def digest(done: DataFrame, with_text: bool = False) -> DataFrame:
    """Figures of each text; on request what is kept of it (the rest of a cut character as U+FFFD)."""
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, r: acc + r["to"] - r["from"])
    return done.select(
        F.col("row.doc_id").cast("long").alias("doc_id"),
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        *([F.make_valid_utf8(F.col("kept").cast("string")).alias("text")] if with_text else []),
    )
