"""Exact deduplication: filters, snapshots, byte checks."""

import numpy as np
from conftest import SF001
from helpers import CLASHING, table
from ledgerlens.llm import fuse_exact as E
from ledgerlens.llm.catalog import ORACLE_SQL, op8_fuse_exact
from oracle_util import compare, duck
from pyspark.sql import functions as F


def test_binary_fuse_holds_all_keys_and_few_others():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 17, 1000, 60_000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        fuse = E.BinaryFuse.build(keys)
        assert fuse.holds(keys).all()
        assert fuse.holds(rng.integers(0, 1 << 63, 50_000, dtype=np.uint64)).mean() < 0.006
        assert n < 1000 or len(fuse.prints) < 1.8 * n


def test_table_against_sql(spark):
    assert compare(op8_fuse_exact(spark, SF001).toPandas(), duck(SF001).sql(ORACLE_SQL["op8_fuse_exact"]).df()) == []


def test_awkward_rows_and_keep_first(spark):
    docs = table(spark, clash=CLASHING)
    got = E.group(docs).collect()
    assert len(got) == docs.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert [(r["keep_id"], r["group_size"], r["kept"]) for r in by_id[1]] == [(1, 3, True)]
    assert [(r["keep_id"], r["kept"]) for r in by_id[5]] == [(1, False)] * 2
    assert by_id[2][0]["keep_id"] == by_id[3][0]["keep_id"] == 2
    assert by_id[4][0]["group_size"] == 1  # " " is not the empty text
    assert (by_id[None][0]["keep_id"], by_id[None][0]["kept"]) == (None, True)
    kept = E.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "4", "6", "7", "8", "None"]
    assert E.group(docs.limit(0)).count() == 0 and E.keep_first(docs.limit(0)).count() == 0


def test_repeated_rows_keep_exactly_one(spark):
    docs = table(spark, [(3, "a  b"), (3, "a b"), (3, "a\nb"), (4, "a b"), (None, "a b")])
    got = E.group(docs).collect()
    assert [r["group_size"] for r in got] == [5] * 5 and sum(r["kept"] for r in got) == 1
    assert E.keep_first(docs).count() == 1


def test_byte_check_takes_colliding_digests_apart(spark):
    weak = lambda text: F.substring(F.sha2(text, 256), 1, 1)  # noqa: E731  sixteen digests for all texts
    docs = table(spark, [(i, f"text {i % 40}") for i in range(100)])
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in E.group(docs, digest=weak).collect()}
    assert got == {i: (i % 40, 3 if i % 40 < 20 else 2) for i in range(100)}


def test_a_batch_meets_every_snapshot_and_filters_screen(spark):
    store = E.Store()
    batches = [[(i, f"t{i}") for i in range(200)], [(300 + i, f"t{100 + i}") for i in range(200)], [(900, "t250"), (901, "new")]]
    results = [E.ingest(store, E.digests(table(spark, b)), shard_keys=50).collect() for b in batches]
    assert len(store.snapshots) == 3 and store.snapshots[0].shards > 1
    assert {r["rows"] for r in results[0]} == {1}
    assert sorted(r["rows"] for r in results[1]) == [1] * 100 + [2] * 100
    assert sorted((r["keep_id"], r["rows"]) for r in results[2]) == [(450, 2), (901, 1)]
    strangers = E.digests(table(spark, [(i, f"stranger {i}") for i in range(3000)]))
    assert E.screen(strangers, store.snapshots[0]).count() < 60
    own = E.digests(table(spark, batches[0]))
    assert E.screen(own, store.snapshots[0]).count() == 200


def test_probe_groups_stay_small_behind_a_small_older_batch(spark):
    store = E.Store()
    E.ingest(store, E.digests(table(spark, [(0, "stray")])), shard_keys=50)
    assert store.snapshots[0].shards == 1
    batch = E.digests(table(spark, [(None, f"t{i}") for i in range(1000)] + [(None, "stray")]))
    dealt, salts = E.dealt_for(batch, store.snapshots[0])
    sizes = [r["count"] for r in dealt.groupBy("shard", "salt").count().collect()]
    assert salts == 21 and sum(sizes) == 1001 and max(sizes) <= 100
    got = {r["rows"] for r in E.ingest(store, batch, shard_keys=50).collect()}
    assert got == {1, 2}
