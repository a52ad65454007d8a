"""Exact deduplication against immutable snapshots, screened by binary fuse filters.

A batch of documents is reduced to digests (SHA-256 of the normalised text).
Duplicates inside the batch are grouped on their own.  Each snapshot written
earlier has exact buckets (one row per digest) and, for each shard of the
digest space, a static three-wise binary fuse filter.  A batch's digests meet
the filters shard by shard; only the positives are joined to the exact buckets,
and a bucket of more than one row is checked byte by byte: its least and its
greatest normalised text must be equal, an aggregate that needs no pairs and
combines on the map side.  A bucket that fails falls apart by text.

Counts by (id, digest) stand for repeated rows, so no row of a hot text is ever
collected; the result unfolds them again.

Defined cases: null counts as the empty text; of repeated rows with the least
id exactly one is kept; a null doc_id is kept only if its group has no other
id; extra columns are not read by ``group`` and pass through ``keep_first``;
no rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import (
    SPACE_RUN,
    id_midpoint,
    is_older,
    join_counted,
    release_shuffles,
    scratch,
    text_of,
)
from ledgerlens.llm.tasks import cogroup_task, group_task

#: Digests of a shard: a filter of about 9 bits each, built in one task.
SHARD_KEYS = 200_000
FILTERS = "shard int, seed long, segment long, segments long, prints binary"


# --- binary fuse filter -------------------------------------------------------


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64(seed)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


@dataclass
class BinaryFuse:
    """Eight-bit prints in overlapping segments; a key's three slots xor to its print."""

    seed: int
    segment: int
    segments: int
    prints: np.ndarray

    @staticmethod
    def _slots(h: np.ndarray, segment: int, segments: int) -> np.ndarray:
        first = ((h >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)
        low = segment - 1
        places = [(h & np.uint64(low)), (h >> np.uint64(16)) & np.uint64(low), (h >> np.uint64(21)) & np.uint64(low)]
        # three consecutive segments, one slot in each
        return np.stack([(first + i) * segment + (p.astype(np.int64) ^ (i * 0x2A & low)) for i, p in enumerate(places)])

    @staticmethod
    def _prints(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(40))) & np.uint64(0xFF)).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuse:
        """``keys``: different unsigned 64-bit integers."""
        n = max(1, len(keys))
        segment = 1 << max(2, min(18, int(np.log(n) / np.log(3.33) + 2.25)))
        factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
        segments = max(1, int(-(-n * factor // segment)))
        seed = 1
        while True:
            order = cls._peel(h := _mix(keys, seed), segment, segments)
            if order is not None:
                break
            seed += 1
            if seed % 16 == 0:  # never seen for different keys; room always helps
                segments += max(1, segments // 8)
        prints = np.zeros((segments + 2) * segment, np.uint8)
        slots, own = cls._slots(h, segment, segments), cls._prints(h)
        for chosen, slot in reversed(order):
            # keys of a round have slots of their own, so a round is set at once
            value = own[chosen] ^ prints[slots[0, chosen]] ^ prints[slots[1, chosen]] ^ prints[slots[2, chosen]]
            prints[slot] = value
        return cls(seed, segment, segments, prints)

    @classmethod
    def _peel(cls, h: np.ndarray, segment: int, segments: int):
        """Rounds of (keys, the slot that only this key still uses), or None."""
        slots = cls._slots(h, segment, segments)
        size = (segments + 2) * segment
        count = np.bincount(slots.ravel(), minlength=size)
        total = np.zeros(size, np.int64)  # sum of the indices of the keys of a slot
        np.add.at(total, slots.ravel(), np.tile(np.arange(len(h)), 3))
        left, rounds = len(h), []
        while left:
            single = np.flatnonzero(count == 1)
            if not len(single):
                return None
            chosen, at = np.unique(total[single], return_index=True)
            rounds.append((chosen, single[at]))
            gone = slots[:, chosen].ravel()
            np.subtract.at(count, gone, 1)
            np.subtract.at(total, gone, np.tile(chosen, 3))
            left -= len(chosen)
        return rounds

    def holds(self, keys: np.ndarray) -> np.ndarray:
        h = _mix(keys, self.seed)
        slots = self._slots(h, self.segment, self.segments)
        found = self.prints[slots[0]] ^ self.prints[slots[1]] ^ self.prints[slots[2]]
        return found == self._prints(h)


def build_filter(key, table: pa.Table) -> pa.Table:
    keys = table.column("word").to_numpy().view(np.uint64)
    fuse = BinaryFuse.build(np.unique(keys))
    return pa.table(
        {
            "shard": pa.array([key[0].as_py()], pa.int32()),
            "seed": pa.array([fuse.seed], pa.int64()),
            "segment": pa.array([fuse.segment], pa.int64()),
            "segments": pa.array([fuse.segments], pa.int64()),
            "prints": pa.array([fuse.prints.tobytes()], pa.binary()),
        }
    )


def probe_filter(key, digests: pa.Table, filters: pa.Table) -> pa.Table:
    """The digests that the shard's filter may hold."""
    if not len(filters) or not len(digests):
        return digests.slice(0, 0)
    row = filters.to_pylist()[0]
    fuse = BinaryFuse(row["seed"], row["segment"], row["segments"], np.frombuffer(row["prints"], np.uint8))
    return digests.filter(pa.array(fuse.holds(digests.column("word").to_numpy().view(np.uint64))))


# --- batches and snapshots ----------------------------------------------------


@dataclass
class Snapshot:
    """Exact buckets (``sha, keep_id, rows``) and the filters of their shards; never changed."""

    buckets: DataFrame
    filters: DataFrame
    shards: int
    shard_keys: int = SHARD_KEYS


@dataclass
class Store:
    """The snapshots so far."""

    snapshots: list[Snapshot] = field(default_factory=list)


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE_RUN, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def digests(docs: DataFrame, digest=sha256) -> DataFrame:
    """``doc_id, sha, rows``: how many rows of an id have a digest."""
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(normalised(text_of())).alias("sha"))
        .groupBy("doc_id", "sha")
        .agg(F.count("*").alias("rows"))
    )


def _sharded(buckets: DataFrame, shards: int) -> DataFrame:
    word = F.xxhash64("sha")
    return buckets.withColumn("word", word).withColumn("shard", F.pmod(F.xxhash64("word"), F.lit(shards)).cast("int"))


def take_snapshot(buckets: DataFrame, shard_keys: int = SHARD_KEYS) -> Snapshot:
    """Write a batch's buckets as an immutable snapshot with one filter per shard."""
    shards = max(1, -(-buckets.count() // shard_keys))
    filters = _sharded(buckets, shards).select("shard", "word").groupBy("shard").applyInArrow(
        group_task(build_filter), FILTERS
    )
    return Snapshot(buckets, scratch(filters, "fuse"), shards, shard_keys)


def dealt_for(batch: DataFrame, snapshot: Snapshot) -> tuple[DataFrame, int]:
    """``sha, word, shard, salt`` of a batch, and the number of salts.

    However few shards a snapshot has, a shard and salt gets about ``shard_keys`` digests.
    """
    salts = max(1, -(-batch.count() // (snapshot.shards * snapshot.shard_keys)))
    dealt = _sharded(batch.select("sha"), snapshot.shards)
    return dealt.withColumn("salt", F.pmod(F.xxhash64("word", F.lit(1)), F.lit(salts)).cast("int")), salts


def screen(batch: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The digests of ``batch`` (column ``sha``) that the snapshot's filters let through."""
    dealt, salts = dealt_for(batch, snapshot)
    filters = snapshot.filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    schema = "sha string, word long, shard int, salt int"
    return (
        dealt.groupBy("shard", "salt")
        .cogroup(filters.groupBy("shard", "salt"))
        .applyInArrow(cogroup_task(probe_filter), schema)
        .select("sha")
    )


def ingest(store: Store, batch: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """Group a batch of ``digests`` rows, look its digests up, and add a snapshot of it.

    Returns ``sha, keep_id, rows`` of the batch's buckets with those of the
    snapshots merged in.
    """
    own = scratch(
        batch.groupBy("sha").agg(F.min("doc_id").alias("keep_id"), F.sum("rows").alias("rows")), "buckets"
    )
    merged = own
    for snapshot in store.snapshots:
        positive = screen(own, snapshot)
        exact = snapshot.buckets.join(positive, "sha", "left_semi")
        merged = merged.unionByName(exact)
    store.snapshots.append(take_snapshot(own, shard_keys))
    return merged.groupBy("sha").agg(F.min("keep_id").alias("keep_id"), F.sum("rows").alias("rows"))


def _all_buckets(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Buckets of the older batch that the newer one doesn't have, and all of the newer."""
    return older.join(newer, "sha", "left_anti").unionByName(newer)


def _members(docs: DataFrame, multiple: DataFrame, digest) -> DataFrame:
    """``doc_id, sha, norm`` of the rows in ``multiple`` (doc_id, sha): dealt by row, not by digest."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), normalised(text_of()).alias("norm")
    ).select("doc_id", digest(F.col("norm")).alias("sha"), "norm")
    return rows.join(
        multiple, rows["doc_id"].eqNullSafe(multiple["doc_id"]) & (rows["sha"] == multiple["sha"]), "left_semi"
    )


def buckets_of(docs: DataFrame, digest=sha256, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, DataFrame]:
    """(``doc_id, sha, rows`` of all rows; ``sha, part, keep_id, size`` of all buckets).

    The table is taken in as two batches, the older ids first; the second meets
    the first one's snapshot.  ``part`` is null but where a digest stands for
    different texts: there it is the text, and each has a bucket of its own.
    """
    spark = docs.sparkSession
    middle = id_midpoint(docs)
    rows = scratch(digests(docs, digest), "digests")
    store = Store()
    older = ingest(store, rows.where(is_older(middle)), shard_keys)
    newer = ingest(store, rows.where(~is_older(middle)), shard_keys)
    buckets = scratch(_all_buckets(older, newer), "buckets")
    release_shuffles(spark)

    several = buckets.where("rows > 1")
    total = several.agg(F.sum("rows")).first()[0] or 0
    counted = several.select("sha", F.col("rows").alias("size"))
    multiple = join_counted(rows, counted, ["sha"], "size", total, "left_semi").select("doc_id", "sha")
    checked = scratch(
        _members(docs, multiple, digest)
        .groupBy("sha")
        .agg((F.min("norm") == F.max("norm")).alias("same")),
        "checked",
    )
    release_shuffles(spark)
    wrong = checked.where("not same").select("sha")
    whole = buckets.join(wrong, "sha", "left_anti").select(
        "sha", F.lit(None).cast("string").alias("part"), "keep_id", F.col("rows").alias("size")
    )
    if wrong.isEmpty():
        return rows, whole
    split = (
        _members(docs, rows.join(wrong, "sha", "left_semi"), digest)
        .groupBy("sha", F.col("norm").alias("part"))
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("size"))
    )
    return rows, whole.unionByName(split)


def _placed(docs: DataFrame, digest, shard_keys: int) -> DataFrame:
    """``doc_id, sha, rows, keep_id, size`` by id and digest (and text, where a digest has several)."""
    rows, buckets = buckets_of(docs, digest, shard_keys)
    whole = buckets.where("part is null").drop("part")
    total = rows.agg(F.sum("rows")).first()[0] or 0
    plain = join_counted(rows, whole, ["sha"], "size", total)
    apart = buckets.where("part is not null")
    if apart.isEmpty():
        return plain
    members = _members(docs, rows.join(apart, "sha", "left_semi"), digest)
    own = members.groupBy("doc_id", "sha", F.col("norm").alias("part")).agg(F.count("*").alias("rows"))
    return plain.unionByName(own.join(apart, ["sha", "part"]).drop("part"))


def group(docs: DataFrame, digest=sha256, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of each row."""
    placed = _placed(docs, digest, shard_keys)
    unfolded = placed.select(
        "doc_id", "keep_id", "size", "sha", F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("nth")
    )
    return unfolded.select(
        "doc_id",
        "keep_id",
        F.col("size").cast("long").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def keep_first(docs: DataFrame, digest=sha256, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """Of equal texts the row with the least id stays, columns as given.

    Rows that go are few beside those that stay, and only they are looked up.
    """
    placed = scratch(_placed(docs, digest, shard_keys), "placed")
    goes = placed.where(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", "sha").distinct()
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        digest(normalised(text_of())).alias("sha"),
    )
    stays = rows.join(goes, rows["doc_id"].eqNullSafe(goes["doc_id"]) & (rows["sha"] == goes["sha"]), "left_anti")
    if not placed.where("rows > 1 and doc_id <=> keep_id").isEmpty():
        stays = stays.dropDuplicates(["doc_id", "sha"])
    return stays.select("row.*")

