"""Line deduplication with exact reference counts behind sharded cuckoo filters.

A line's key is its stripped, lower-cased text; the state holds, for every key,
the number of documents that have it (exact, one row per key), and for every
shard of the key space a cuckoo filter of the keys present.  A batch of
documents is first summed up by key.  Keys that the filters don't know are new
rows; the others meet the exact table, which also settles false positives.
Deleting documents runs the same way with negative counts; a key whose count
reaches zero leaves the table and its filter, so dropping a line is undone when
the documents that made it common go.  A filter that overflows is built again,
larger, from the exact counts.

Lines of keys found in at least ``MIN_DOCS`` documents are dropped everywhere.

Defined cases: a null or empty text is one empty line and keeps it; empty keys
never count; repeated rows are documents of their own; a null doc_id stays
null; extra columns are not read; no rows give no rows.  Keys are told apart by
128-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import (
    SPACES,
    id_midpoint,
    is_older,
    join_counted,
    keyed,
    release_shuffles,
    same_row,
    scratch,
    utf8,
)
from ledgerlens.llm.tasks import cogroup_task, group_task, map_task

MIN_DOCS = 10
SHARD_KEYS = 200_000
KEYS = "doc_id long, rk long, k1 long, k2 long"
FILTERS = "shard int, buckets long, slots binary, full boolean"
KEPT = "doc_id long, n_lines long, n_dropped long, kept_text binary"


# --- cuckoo filter ------------------------------------------------------------


class Cuckoo:
    """Sixteen-bit prints, four to a bucket; a print can be taken out again."""

    WAYS, KICKS = 4, 500

    def __init__(self, buckets: int, slots: np.ndarray | None = None):
        self.buckets = buckets
        self.slots = slots if slots is not None else np.zeros((buckets, self.WAYS), np.uint16)

    @classmethod
    def of(cls, keys: np.ndarray) -> Cuckoo:
        """A filter of all ``keys``, at most three quarters full."""
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, len(keys)) / (0.75 * cls.WAYS)))))
        while True:
            made = cls(buckets)
            if made.insert(keys):
                return made
            buckets *= 2

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        prints = ((h >> np.uint64(8)) % np.uint64(65535)).astype(np.int64) + 1
        first = (h >> np.uint64(24)).astype(np.int64) & (self.buckets - 1)
        return prints, first, self._other(first, prints)

    def _other(self, bucket, prints):
        return bucket ^ ((prints * 0x5BD1E995 >> 3) & (self.buckets - 1))

    def holds(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(keys)
        own = prints[:, None].astype(np.uint16)
        return (self.slots[first] == own).any(axis=1) | (self.slots[second] == own).any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """Put all keys in; False if there is no room (the filter is of no use then)."""
        table = self.slots.tolist()
        seed = 1
        for print_, a, b in zip(*(x.tolist() for x in self._places(keys))):
            for bucket in (a, b):
                if 0 in table[bucket]:
                    table[bucket][table[bucket].index(0)] = print_
                    break
            else:
                bucket = a
                for _ in range(self.KICKS):
                    seed = (seed * 1103515245 + 12345) & 0x7FFFFFFF
                    way = (seed >> 16) % self.WAYS
                    table[bucket][way], print_ = print_, table[bucket][way]
                    bucket = self._other(bucket, print_)
                    if 0 in table[bucket]:
                        table[bucket][table[bucket].index(0)] = print_
                        break
                else:
                    return False
        self.slots = np.array(table, np.uint16)
        return True

    def delete(self, keys: np.ndarray) -> None:
        """Take out keys that were put in."""
        for print_, a, b in zip(*(x.tolist() for x in self._places(keys))):
            for bucket in (a, b):
                at = np.flatnonzero(self.slots[bucket] == print_)
                if len(at):
                    self.slots[bucket, at[0]] = 0
                    break


def _filter_row(shard: int, made: Cuckoo, full: bool = False) -> pa.Table:
    return pa.table(
        {
            "shard": pa.array([shard], pa.int32()),
            "buckets": pa.array([made.buckets], pa.int64()),
            "slots": pa.array([made.slots.tobytes()], pa.binary()),
            "full": pa.array([full], pa.bool_()),
        }
    )


def _read_filter(filters: pa.Table) -> Cuckoo | None:
    if not len(filters):
        return None
    row = filters.to_pylist()[0]
    slots = np.frombuffer(row["slots"], np.uint16).reshape(row["buckets"], Cuckoo.WAYS).copy()
    return Cuckoo(row["buckets"], slots)


def build_filter(key, table: pa.Table) -> pa.Table:
    return _filter_row(key[0].as_py(), Cuckoo.of(table.column("k1").to_numpy().view(np.uint64)))


def probe_filter(key, deltas: pa.Table, filters: pa.Table) -> pa.Table:
    """Flags the keys that the shard's filter may hold."""
    made = _read_filter(filters)
    if made is None or not len(deltas):
        seen = np.zeros(len(deltas), bool)
    else:
        seen = made.holds(deltas.column("k1").to_numpy().view(np.uint64))
    return deltas.append_column("seen", pa.array(seen))


def update_filter(key, changes: pa.Table, filters: pa.Table) -> pa.Table:
    """Insert the keys that came, delete those that went; ``full`` if they don't fit."""
    made = _read_filter(filters)
    came = changes.column("came").to_numpy(zero_copy_only=False).astype(bool)
    keys = changes.column("k1").to_numpy().view(np.uint64)
    if made is None:
        return _filter_row(key[0].as_py(), Cuckoo.of(keys[came]))
    made.delete(keys[~came])
    fits = made.insert(keys[came])
    return _filter_row(key[0].as_py(), made, full=not fits)


# --- state --------------------------------------------------------------------


@dataclass
class LineState:
    """``refs`` (k1, k2, refs, shard): documents by key; ``filters``: one row per shard."""

    refs: DataFrame
    filters: DataFrame
    shards: int
    shard_keys: int = SHARD_KEYS


def _shard(shards: int):
    return F.pmod(F.xxhash64("k2"), F.lit(shards)).cast("int")


def counted(keys: DataFrame, sign: int = 1) -> DataFrame:
    """``k1, k2, delta``: how many documents of a batch hold each key."""
    return keys.groupBy("k1", "k2").agg((F.count("*") * sign).alias("delta"))


def start(keys: DataFrame, shard_keys: int = SHARD_KEYS) -> LineState:
    """The state of a first batch of document keys."""
    counts = counted(keys)
    refs = scratch(counts.select("k1", "k2", F.col("delta").alias("refs")), "refs")
    return _state(refs, max(1, -(-refs.count() // shard_keys)), shard_keys)


def _state(refs: DataFrame, shards: int, shard_keys: int) -> LineState:
    """The state of exact counts (``k1, k2, refs``), all filters built from them."""
    refs = refs.withColumn("shard", _shard(shards))
    filters = refs.select("shard", "k1").groupBy("shard").applyInArrow(group_task(build_filter), FILTERS)
    return LineState(refs, scratch(filters, "cuckoo"), shards, shard_keys)


def dealt_for(keys: DataFrame, state: LineState, sign: int = 1) -> tuple[DataFrame, int]:
    """``k1, k2, delta, shard, salt`` of a batch, and the number of salts.

    However few shards a state has, a shard and salt gets about ``shard_keys`` keys at most.
    """
    salts = max(1, -(-keys.count() // (state.shards * state.shard_keys)))
    salt = F.pmod(F.xxhash64("k1", F.lit(1)), F.lit(salts)).cast("int")
    return counted(keys, sign).withColumn("shard", _shard(state.shards)).withColumn("salt", salt), salts


def apply(state: LineState, keys: DataFrame, sign: int = 1) -> LineState:
    """The state after a batch of document keys came (``sign`` 1) or went (-1).

    When the keys have outgrown the shards, there are more shards from then on,
    their filters built from the exact counts.
    """
    deltas, salts = dealt_for(keys, state, sign)
    filters = state.filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    probed = scratch(
        deltas.groupBy("shard", "salt")
        .cogroup(filters.groupBy("shard", "salt"))
        .applyInArrow(cogroup_task(probe_filter), "k1 long, k2 long, delta long, shard int, salt int, seen boolean"),
        "probed",
    )
    known = probed.where("seen")
    at = ["k1", "k2"]
    met = known.join(state.refs.select(*at, "refs"), at, "left")
    touched = scratch(
        met.select(*at, "shard", F.col("refs").alias("before"), (F.coalesce("refs", F.lit(0)) + F.col("delta")).alias("refs"))
        .unionByName(
            probed.where("not seen").select(
                *at, "shard", F.lit(None).cast("long").alias("before"), F.col("delta").alias("refs")
            )
        ),
        "touched",
    )
    same = state.refs.join(touched.select(*at), at, "left_anti")
    refs = scratch(
        same.select(*at, "refs", "shard").unionByName(touched.where("refs > 0").select(*at, "refs", "shard")), "refs"
    )
    shards = -(-refs.count() // state.shard_keys)
    if shards > 2 * state.shards:
        return _state(refs.drop("shard"), shards, state.shard_keys)
    changes = touched.where("(before is null) <> (refs <= 0)").select(
        "shard", "k1", F.col("before").isNull().alias("came")
    )
    updated = scratch(
        changes.groupBy("shard").cogroup(state.filters.groupBy("shard")).applyInArrow(
            cogroup_task(_update_or_keep), FILTERS
        ),
        "cuckoo",
    )
    full = updated.where("full").select("shard")
    if full.isEmpty():
        return LineState(refs, updated, state.shards, state.shard_keys)
    rebuilt = (
        refs.join(full, "shard", "left_semi").select("shard", "k1").groupBy("shard").applyInArrow(
            group_task(build_filter), FILTERS
        )
    )
    filters = scratch(updated.where("not full").unionByName(rebuilt), "cuckoo")
    return LineState(refs, filters, state.shards, state.shard_keys)


def _update_or_keep(key, changes: pa.Table, filters: pa.Table) -> pa.Table:
    return update_filter(key, changes, filters) if len(changes) else filters


# --- documents ----------------------------------------------------------------

_STRIP = SPACES.encode()


def _line_keys(text: bytes) -> tuple[list[bytes], list[bytes]]:
    """The lines and the 128-bit hash of each key (empty for an empty key)."""
    from xxhash import xxh3_128_digest

    lines = text.split(b"\n")
    keys = [line.strip(_STRIP).lower() for line in lines]
    return lines, [xxh3_128_digest(k) if k else b"" for k in keys]


def key_batches(batches) -> Iterator[pa.RecordBatch]:
    """One row for each different key of each row."""
    for batch in batches:
        found = [sorted(set(_line_keys(t)[1]) - {b""}) for t in utf8(batch.column("text"))]
        counts = [len(f) for f in found]
        words = np.frombuffer(b"".join(k for f in found for k in f), "<i8").reshape(-1, 2)
        index = pa.array(np.repeat(np.arange(len(found)), counts))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(index),
                batch.column("rk").take(index),
                pa.array(np.ascontiguousarray(words[:, 0])),
                pa.array(np.ascontiguousarray(words[:, 1])),
            ],
            ["doc_id", "rk", "k1", "k2"],
        )


def drop_batches(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, n_lines, n_dropped = [], [], []
        for text, common in zip(utf8(batch.column("text")), batch.column("common").to_pylist()):
            lines, keys = _line_keys(text)
            if common:
                gone = {np.array([c["k1"], c["k2"]], "<i8").tobytes() for c in common}
                stay = [line for line, k in zip(lines, keys) if k not in gone]
            else:
                stay = lines
            kept.append(b"\n".join(stay))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n_lines, pa.int64()),
                pa.array(n_dropped, pa.int64()),
                pa.array(kept, pa.binary()),
            ],
            ["doc_id", "n_lines", "n_dropped", "kept_text"],
        )


def document_keys(docs: DataFrame) -> DataFrame:
    return keyed(docs).mapInArrow(map_task(key_batches), KEYS)


def drop_lines(docs: DataFrame, keys: DataFrame, state: LineState, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_text`` of each row under a state.

    ``keys`` are the documents' own keys; a document's common ones are gathered
    for it, never those of the corpus.
    """
    common = state.refs.where(F.col("refs") >= min_docs).select("k1", "k2", "refs")
    total = common.agg(F.sum("refs")).first()[0] or 0
    own = join_counted(keys, common, ["k1", "k2"], "refs", total).groupBy("doc_id", "rk").agg(
        F.collect_set(F.struct("k1", "k2")).alias("common")
    )
    rows = keyed(docs)
    met = rows.join(own, same_row(rows, own), "left").select(rows["doc_id"], rows["text"], "common")
    return met.mapInArrow(map_task(drop_batches), KEPT)


def dedup(docs: DataFrame, min_docs: int = MIN_DOCS, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """Take the older half of the ids in as the first batch, the others as the second, and drop lines."""
    spark: SparkSession = docs.sparkSession
    middle = id_midpoint(docs)
    keys = scratch(document_keys(docs), "lines")
    state = apply(start(keys.where(is_older(middle)), shard_keys), keys.where(~is_older(middle)))
    release_shuffles(spark)
    return drop_lines(docs, keys, state, min_docs)


def digest(dropped: DataFrame) -> DataFrame:
    return dropped.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


