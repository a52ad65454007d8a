"""Fingerprints and groups against brute force."""

import random

import pytest
import xxhash
from conftest import SF0001
from helpers import CLASHING, table
from ledgerlens.llm import simhash_ring as R
from ledgerlens.llm.common import documents


def fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, distance):
    """Root (least node) of each fingerprint, by all pairs."""
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ordered = sorted(fps)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


@pytest.mark.parametrize("bucket", [64, 1])
def test_whole_table_against_brute_force(spark, bucket):
    docs = documents(spark, SF0001)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    fps = {i: fingerprint(t) for i, t in texts.items()}
    root = groups(set(fps.values()), 2)
    least = {}
    for i, f in fps.items():
        least[root[f]] = min(i, least.get(root[f], i))
    got = R.group(docs, bucket=bucket).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r["fp"] & (1 << 64) - 1 == fps[r["doc_id"]]
        assert r["component_id"] == least[root[fps[r["doc_id"]]]]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("distance, segments, bucket", [(2, 7, 64), (2, 7, 3), (2, 5, 1), (1, 4, 1), (3, 8, 2), (3, 8, 64)])
def test_links_lose_no_group(spark, distance, segments, bucket):
    rng = random.Random(distance * 100 + segments)
    fps = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(14):
            flips = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))
            fps.add(centre ^ flips)
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    edges = R.links(df, distance, segments, bucket).collect()
    found = groups_of_edges({signed(f) for f in fps}, [(r["u"], r["v"]) for r in edges])
    want = groups(fps, distance)
    as_sets = lambda roots, f=lambda x: x: {frozenset(f(x) for x in roots if roots[x] == r) for r in set(roots.values())}
    assert as_sets(found) == as_sets(want, signed)
    assert all(((r["u"] ^ r["v"]) & (1 << 64) - 1).bit_count() <= max(distance, 2 * ((distance + 1) // 2)) for r in edges)


def groups_of_edges(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_chains_have_zero_keys_and_growing_budgets():
    for key, budgets in R.chains(7, 2):
        assert 27 <= key.bit_count() <= 28
        assert [b for _, b in budgets] == [1, 2] and budgets[-1][0] == (1 << 64) - 1
        assert all(m & key == key for m, _ in budgets)
    assert sum(R.segment_masks(7)) == (1 << 64) - 1


def test_awkward_rows_and_keep_one(spark):
    docs = table(spark, clash=CLASHING)
    got = R.group(docs).collect()
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[2]["fp"] == by_id[3]["fp"] == by_id[4]["fp"] == 0 and by_id[4]["component_id"] == 2
    assert by_id[5]["component_id"] == 1 and by_id[None]["component_id"] is None
    kept = R.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "6", "7", "8", "None"]
    twice = table(spark, [(5, "the same row again"), (5, "the same row again")])
    assert R.keep_one(twice).count() == 1
    assert R.keep_one(docs.limit(0)).count() == 0
