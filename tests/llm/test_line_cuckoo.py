"""Line deduplication: filter, reference counts, deletions."""

import hashlib
from collections import Counter

import numpy as np
from conftest import SF001
from helpers import CLASHING, table
from ledgerlens.llm import line_cuckoo as L
from ledgerlens.llm.catalog import ORACLE_SQL, op9_line_cuckoo
from oracle_util import compare, duck


def test_cuckoo_inserts_and_deletes():
    rng = np.random.default_rng(6)
    for n in (0, 1, 5, 3000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        made = L.Cuckoo.of(keys)
        assert made.holds(keys).all()
        assert made.holds(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)).mean() < 0.002
        made.delete(keys[: n // 2])
        assert made.holds(keys[n // 2 :]).all()
        assert n < 100 or made.holds(keys[: n // 2]).mean() < 0.01
    small = L.Cuckoo(4)
    assert not small.insert(rng.integers(0, 1 << 63, 40, dtype=np.uint64))


def test_table_against_sql(spark):
    assert compare(op9_line_cuckoo(spark, SF001).toPandas(), duck(SF001).sql(ORACLE_SQL["op9_line_cuckoo"]).df()) == []


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, common_from, min_docs):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(_LOWER)
    found = Counter(k for _, t in common_from for k in {key(x) for x in (t or "").split("\n")} - {""})
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if not key(x) or found[key(x)] < min_docs]
        digest = hashlib.sha256("\n".join(stay).encode()).hexdigest()
        out.append((doc_id, len(lines), len(lines) - len(stay), digest))
    return sorted(out, key=repr)


def test_awkward_rows(spark):
    docs = table(spark, clash=CLASHING)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for least in (1, 2, 3):
        got = sorted(map(tuple, L.digest(L.dedup(docs, min_docs=least)).collect()), key=repr)
        assert got == plain(rows, rows, least)
    assert L.dedup(docs.limit(0)).count() == 0


def test_deleting_documents_undoes_their_lines(spark):
    first = [(i, f"common\nshared {i % 3}\nown {i}") for i in range(12)]
    second = [(100 + i, f"Common \nlate {i}") for i in range(5)]
    keys = [L.document_keys(table(spark, rows)) for rows in (first, second)]
    whole = L.apply(L.start(keys[0], shard_keys=7), keys[1])
    assert whole.shards > 1

    def texts(state, rows, key):
        return sorted(map(tuple, L.digest(L.drop_lines(table(spark, rows), key, state, 4)).collect()), key=repr)

    assert texts(whole, first, keys[0]) == plain(first, first + second, 4)
    without = L.apply(whole, keys[0], sign=-1)
    refs = lambda s: sorted(tuple(r) for r in s.refs.select("k1", "k2", "refs").collect())
    assert refs(without) == refs(L.start(keys[1]))
    assert texts(without, second, keys[1]) == plain(second, second, 4)
    assert refs(L.apply(without, keys[1], sign=-1)) == []
    again = L.apply(without, keys[0])
    assert refs(again) == refs(whole)
    # the filters follow: nothing deleted is flagged more often than by chance
    flagged = without.refs.count()
    slots = sum(int((np.frombuffer(r["slots"], np.uint16) != 0).sum()) for r in without.filters.collect())
    assert slots == flagged


def test_a_full_filter_is_built_again(spark):
    keys = [L.document_keys(table(spark, [(n * 1000 + i, f"line {n} {i}") for i in range(k)])) for n, k in enumerate((3, 400))]
    state = L.apply(L.start(keys[0]), keys[1])
    assert state.refs.count() == 403
    made = L._read_filter(state.filters.toArrow())
    assert made.holds(np.array([r["k1"] for r in state.refs.collect()], np.int64).view(np.uint64)).all()


def test_shards_follow_the_keys_behind_a_small_first_batch(spark):
    first, second = [(0, "line 1")], [(None, f"line {i}") for i in range(500)]
    keys = [L.document_keys(table(spark, rows)) for rows in (first, second)]
    small = L.start(keys[0], shard_keys=25)
    dealt, salts = L.dealt_for(keys[1], small)
    sizes = [r["count"] for r in dealt.groupBy("shard", "salt").count().collect()]
    assert small.shards == 1 and salts == 20 and sum(sizes) == 500 and max(sizes) <= 60
    state = L.apply(small, keys[1])
    assert state.shards == 20 and state.filters.count() == 20
    assert sorted(r["refs"] for r in state.refs.collect()) == [1] * 499 + [2]
    assert max(r["count"] for r in state.refs.groupBy("shard").count().collect()) <= 60
    assert L.apply(L.apply(state, keys[1], sign=-1), keys[0], sign=-1).refs.count() == 0
