"""SimHash fingerprints and their groups, candidates pruned by the pigeonring principle.

The 64 bits are cut into ``segments`` segments on a ring.  If two fingerprints
differ in at most t bits, some segment starts a chain each prefix of which, of
length l, differs in at most floor(l * t / segments) bits.  As long as that
floor is zero the prefix must be equal, so those segments together are the join
key; a pair that meets must also keep the longer prefixes' budgets before the
full Hamming check.  All of it is one condition of an equi-join.

Equal fingerprints are one row before anything is joined.  A bucket of more
than ``BUCKET`` different fingerprints is not paired up: its members differ only
in the bits outside the key, and any two within two bits of each other share a
neighbour at distance one or less (t = 2) - each member is dealt to itself and
its one-bit flips, and all members of a flip are linked to the least of them.
That finds the same groups from a number of rows in proportion to the bucket.

Defined cases: a null or empty text has no shingles and fingerprint zero, which
links like any other; a text of fewer words than a shingle has one shingle of
all of them; repeated rows share a group; a null doc_id never names a group
that holds another id; extra columns are not read; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import keep_rows, keyed, release_shuffles, scratch, utf8
from ledgerlens.llm.components import components
from ledgerlens.llm.tasks import map_task

SHINGLE, DISTANCE, SEGMENTS, BUCKET = 3, 2, 7, 64
SEED = 42
FINGERPRINTS = "doc_id long, rk long, fp long"


def fingerprint(text: bytes, shingle: int) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # bytes: lowers A-Z, splits at 09-0D and 20
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *(ends[: -shingle]).tolist()]
    stops = (ends[shingle - 1 :] - 1).tolist()
    hashes = np.array([xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, stops)], np.uint64)
    set_bits = np.zeros(64, np.int64)
    for part in np.array_split(hashes, 1 + len(hashes) // 65536):
        set_bits += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(hashes)).tobytes(), "big")


def fingerprint_batches(batches, shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t, shingle) for t in utf8(batch.column("text"))], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("rk"), pa.array(found.view(np.int64))], ["doc_id", "rk", "fp"]
        )


def segment_masks(segments: int) -> list[int]:
    """The bits of each segment, from the highest; lengths differ by one at most."""
    bounds = [64 * i // segments for i in range(segments + 1)]
    return [((1 << (b - a)) - 1) << (64 - b) for a, b in zip(bounds, bounds[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def chains(segments: int, distance: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """For each start: the key's mask, and (mask, budget) of the longer prefixes.

    Of prefixes with the same budget only the longest says anything.
    """
    masks = segment_masks(segments)
    found = []
    for start in range(segments):
        key, budgets = 0, {}
        mask = 0
        for length in range(1, segments + 1):
            mask |= masks[(start + length - 1) % segments]
            budget = length * distance // segments
            if budget == 0:
                key = mask
            else:
                budgets[budget] = mask
        found.append((key, [(m, b) for b, m in sorted(budgets.items())]))
    return found


def _bits(a: Column, b: Column, mask: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b).bitwiseAND(F.lit(_signed(mask))))


def links(fps: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS, bucket: int = BUCKET) -> DataFrame:
    """Edges ``u, v`` whose groups are those of all pairs within ``distance`` bits.

    ``fps`` has the different fingerprints, column ``fp``.  Two fingerprints
    are joined if a chain of segments proves them candidates and the Hamming
    check holds; in a large bucket they are linked by way of a common flip.
    """
    if distance < 1 or segments <= distance:
        raise ValueError("at least one bit of distance, and more segments than that")
    ring = chains(segments, distance)
    dealt = fps.select(
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(k))) for k, _ in ring])).alias("start", "part"),
        "fp",
    )
    sizes = dealt.groupBy("start", "part").agg(F.count("*").alias("n")).where("n > 1")
    met = scratch(dealt.join(sizes, ["start", "part"]), "buckets")
    a, b = (met.where(F.col("n") <= bucket).select("start", "part", F.col("fp").alias(x)) for x in ("a", "b"))
    left, right = a.alias("l"), b.alias("r")
    paired = left.join(
        right,
        (F.col("l.start") == F.col("r.start")) & (F.col("l.part") == F.col("r.part")) & (F.col("a") < F.col("b"))
        & reduce(
            lambda x, y: x | y,
            [
                (F.col("l.start") == i)
                & reduce(lambda x, y: x & y, [_bits(F.col("a"), F.col("b"), m) <= budget for m, budget in budgets])
                for i, (_, budgets) in enumerate(ring)
            ],
        )
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance),
    ).select(F.col("a").alias("u"), F.col("b").alias("v"))
    return paired.unionByName(_crowded(met.where(F.col("n") > bucket), ring, distance))


def _flips(mask: int, bits: int) -> list[int]:
    """All masks of at most ``bits`` bits inside ``mask``."""
    ones = [1 << i for i in range(64) if mask >> i & 1]
    found = {0}
    for _ in range(bits):
        found |= {f | o for f in found for o in ones}
    return sorted(found)


def _crowded(met: DataFrame, ring, distance: int) -> DataFrame:
    """Links of large buckets by way of common flips outside the bucket's key.

    Two members within ``distance`` bits share a string at half that distance
    from both (rounded up); two that share one are within twice that.  For an
    even distance these are the same pairs; for an odd one the members of a
    flip are checked against each other's distance by one bit less flipped on
    one side.
    """
    near, far = (distance + 1) // 2, distance // 2
    all_bits = (1 << 64) - 1

    def flipped(bits: int) -> DataFrame:
        return met.select(
            "start",
            "part",
            "fp",
            F.explode(
                F.element_at(
                    F.array(*[F.array(*[F.lit(_signed(f)) for f in _flips(all_bits & ~k, bits)]) for k, _ in ring]),
                    F.col("start") + 1,
                )
            ).alias("flip"),
        ).select("start", "part", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"))

    at = ["start", "part", "centre"]
    if near == far:
        dealt = flipped(near)
        least = dealt.groupBy(at).agg(F.min("fp").alias("least"), F.count("*").alias("n")).where("n > 1")
        pairs = dealt.join(least, at).where("fp <> least").select(F.col("fp").alias("u"), F.col("least").alias("v"))
    else:
        one, other = flipped(near), flipped(far).withColumnRenamed("fp", "least")
        pairs = one.join(other, at).where("fp <> least").select(F.col("fp").alias("u"), F.col("least").alias("v"))
    return pairs.distinct()


def group(
    docs: DataFrame,
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    segments: int = SEGMENTS,
    bucket: int = BUCKET,
) -> DataFrame:
    """``doc_id, rk, fp, component_id, keep_id, keep_rk, n`` of each row of ``docs``.

    ``component_id`` is the least id of the group; ``keep_id, keep_rk`` name the
    row that stands for it (null ids last, then the least hash), and ``n`` says
    how many rows it has.
    """
    spark = docs.sparkSession
    prints = scratch(keyed(docs).mapInArrow(map_task(fingerprint_batches, shingle=shingle), FINGERPRINTS), "fps")
    fps = prints.groupBy("fp").agg(
        F.min("doc_id").alias("least"),
        F.min_by("rk", F.struct(F.col("doc_id").isNull(), "doc_id", "rk")).alias("least_rk"),
        F.count("*").alias("n"),
    )
    roots = components(links(fps.select("fp"), distance, segments, bucket))
    release_shuffles(spark)
    placed = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least", "least_rk", "n"
    )
    order = F.struct(F.col("least").isNull(), "least", "least_rk")
    groups = placed.groupBy("root").agg(
        F.min("least").alias("component_id"),
        F.min_by("least_rk", order).alias("keep_rk"),
        F.sum("n").alias("n"),
    )
    named = placed.select("fp", "root").join(groups, "root").drop("root")
    return prints.join(named, "fp").select(
        "doc_id", "rk", "fp", "component_id", F.col("component_id").alias("keep_id"), "keep_rk", "n"
    )


def keep_one(docs: DataFrame, **parameters) -> DataFrame:
    """One row of each group stays, the columns as given."""
    groups = group(docs, **parameters)
    stays = groups.where(F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("rk") == F.col("keep_rk")))
    keys = scratch(stays.groupBy("doc_id", "rk").agg(F.count("*").alias("n")), "stays")
    repeated = not keys.where("n > 1").isEmpty()
    return keep_rows(docs, keys.select("doc_id", "rk"), repeated)
