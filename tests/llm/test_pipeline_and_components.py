"""Connected components, the pipeline's stages and the package's boundary."""

import os
import random
import subprocess
import sys

import __spark_entry__ as entry
import corpus_pipeline as P
from conftest import SF0001
from helpers import CLASHING, table
from ledgerlens.llm.common import documents
from ledgerlens.llm.components import components
from test_simhash_ring import groups_of_edges

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1001 + i) for i in range(50)] + [(7000, 7000)]
    edges += [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(70)] + [(3, 4), (4, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    want = groups_of_edges(nodes, [e for e in edges if e[0] != e[1]])
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
    text = components(spark.createDataFrame([("b", "a"), ("c", "b")], "u string, v string")).collect()
    assert {r["node"]: r["root"] for r in text} == {"a": "a", "b": "a", "c": "a"}


def test_hot_keys_are_joined_apart_with_the_same_result(spark, monkeypatch):
    from ledgerlens.llm import common

    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 50}") for i in range(600)], "id long, key string")
    side = rows.groupBy("key").count().withColumnRenamed("count", "n")
    for share in (1, 2, 1000):
        monkeypatch.setattr(common, "HOT_SHARE", share)
        inner = common.join_counted(rows, side, ["key"], "n", 600)
        assert sorted(map(tuple, inner.collect())) == sorted(map(tuple, rows.join(side, "key").collect()))
        some = side.where("key <> 'k0'")
        semi = common.join_counted(rows, some, ["key"], "n", 600, "left_semi")
        assert sorted(map(tuple, semi.select("id").collect())) == sorted(
            (r["id"],) for r in rows.collect() if r["key"] != "k0"
        )
    assert common.join_counted(rows.limit(0), side.limit(0), ["key"], "n", 0).count() == 0


def test_every_query_is_registered():
    names = list(entry.LLM_QUERIES)
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
    assert [n for n, _ in P.STAGES] == ["quality", "exact_dedup", "simhash_dedup", "suffix_dedup", "packing"]


def test_stages_keep_the_columns_and_clean_documents(spark):
    docs = documents(spark, SF0001)
    columns, ids = docs.columns, None
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF0001).cache()
        assert docs.columns == columns, name
        kept = sorted(r["doc_id"] for r in docs.select("doc_id").collect())
        assert len(kept) == len(set(kept)) and (ids is None or set(kept) <= ids)
        ids = set(kept)
    whole = P.run(spark, SF0001).select("doc_id").distinct().collect()
    assert {r["doc_id"] for r in whole} == ids


def test_stages_take_awkward_rows(spark):
    docs = table(spark, clash=CLASHING)
    for rows in (docs, docs.limit(0)):
        for name, stage in P.STAGES[:-1]:
            assert stage(spark, rows, SF0001).columns == docs.columns, name
            stage(spark, rows, SF0001).collect()


def test_repeated_passages_of_over_fifty_words_go(spark):
    """Passages of 51 to 60 words in two documents each; shorter repeats and clean documents stay."""
    rng = random.Random(8)

    def words(n):
        return ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(n)]

    rows, passages = [], []
    for n in range(51, 61):
        passage = " ".join(words(n))
        passages.append(passage)
        rows += [(len(rows) + i, " ".join([*words(70), passage, *words(70)])) for i in range(2)]
    short = " ".join(words(45))
    rows += [(100 + i, " ".join([*words(60), short, *words(60)])) for i in range(3)]
    rows += [(200 + i, " ".join(words(150))) for i in range(5)]
    rows += [(300, None), (301, "")]
    kept = {r["doc_id"]: r["text"] for r in P.suffix_dedup(spark, table(spark, rows), SF0001).collect()}
    assert set(kept) == {i for i, _ in rows}
    for i, text in rows:
        if i < 100:
            # all but the words at the passage's ends, which may match by chance
            left = text.replace(passages[i // 2], "")
            assert abs(len(kept[i]) - len(left)) < 12 and passages[i // 2] not in kept[i]
        else:
            assert kept[i] == text or (text is None and not kept[i])


def test_the_rest_does_without_this_package():
    code = (
        "import sys\n"
        "class No:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('ledgerlens.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, No())\n"
        "import __spark_entry__ as e\n"
        "assert not e.LLM_QUERIES and not [k for k in e.queries() if k.startswith('op')]\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
    absent = code.replace("name == 'corpus_pipeline' or name.startswith('ledgerlens.llm')", "name == 'public_tokenizers'")
    subprocess.run([sys.executable, "-c", absent], cwd=ROOT, check=True, timeout=120)
