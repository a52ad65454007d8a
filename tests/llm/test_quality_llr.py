"""Quality rules and likelihood ratio against brute force."""

import math
import re
import zlib
from collections import Counter

import xxhash
from conftest import SF001, SF0001
from helpers import CLASHING, table
from ledgerlens.llm import quality_llr as Q
from ledgerlens.llm.common import documents
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    found = Counter(windows)
    covered = {j for i, w in enumerate(windows) if found[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n_dup = len(lines) - len(set(lines))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), n_dup, len(covered), failed


def grams(text):
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORD.findall(text or "")]
    pairs = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42))
             for a, b in zip(hashes, hashes[1:])]
    return hashes + pairs


def bucket(h, buckets):
    return (h - (1 << 64) if h >> 63 else h) % buckets


FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_whole_table_against_brute_force(spark):
    docs, labels = documents(spark, SF0001), Q.labels_of(spark, SF0001)
    buckets, prior = 4096, 1000
    model = Q.fit(docs, labels, buckets=buckets, prior=prior)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1 and r["toxic"] == 0} & set(texts)
    raw = Counter(bucket(h, buckets) for t in texts.values() for h in grams(t))
    target = Counter(bucket(h, buckets) for i in good for h in grams(texts[i]))
    n_raw, n_target = sum(raw.values()), sum(target.values())
    for b, n in raw.items():
        share = n / n_raw
        ratio = math.log((target[b] + prior * share) / (n_target + prior) / share)
        assert abs(model[b] - 1e6 * ratio) <= 1
    judged = Q.judge(docs, model, threshold=-200_000).collect()
    assert len(judged) == len(texts)
    for r in judged:
        text = texts[r["row"]["doc_id"]]
        assert tuple(r[f] for f in FIGURES) == base(text)
        score = sum(model[bucket(h, buckets)] for h in grams(text))
        assert (r["ratio_sum"], r["n_grams"]) == (score, len(grams(text)))
        assert r["kept"] == (not r["base_failed"] and score >= -200_000 * r["n_grams"])


def test_awkward_rows_and_clashing_columns(spark):
    docs = table(spark, clash=CLASHING)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (5, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert [r[0] for r in Q.trusted_ids(labels).collect()] == [5]
    judged = Q.judge(docs, Q.fit(docs, labels)).collect()
    assert len(judged) == docs.count()
    for r in judged:
        assert tuple(r[f] for f in FIGURES) == base(r["row"]["text"])
        assert r["row"].asDict().keys() == set(docs.columns)


def test_no_trusted_text_rejects_nothing_and_no_rows_give_none(spark):
    docs = table(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = Q.fit(docs, none)
    assert set(model) == {0}
    assert all(r["kept"] != r["base_failed"] for r in Q.judge(docs, model).collect())
    assert Q.judge(docs.limit(0), Q.fit(docs.limit(0), none)).count() == 0


def verdicts(docs, labels):
    judged = Q.fit_judge(docs, labels).select("row.doc_id", "base_failed", "kept").collect()
    return {r["doc_id"]: (r["base_failed"], r["kept"]) for r in judged}


def test_ratio_rejects_bad_texts_on_held_out_labels(spark):
    """Precision and recall on labels that neither the target nor the threshold's good texts saw as trusted."""
    docs, labels = documents(spark, SF001), Q.labels_of(spark, SF001)
    got = verdicts(docs, labels)
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    passed = {i: kept for i, (failed, kept) in got.items() if not failed and i in known}
    bad = [kept for i, kept in passed.items() if known[i] == 0]
    good = [kept for i, kept in passed.items() if known[i] == 1]
    assert sum(not k for k in bad) / len(bad) >= 0.9
    assert sum(good) / len(good) >= 0.98


def test_verdicts_don_t_depend_on_the_corpus_size(spark):
    """Tenfold copies of all texts and labels: the same verdicts and ratios."""
    docs = documents(spark, SF0001).select("doc_id", "text")
    labels = Q.labels_of(spark, SF0001)
    # ids of copies that fall into the same fold as their original
    copies = []
    for r in labels.select("doc_id").union(docs.select("doc_id")).distinct().collect():
        fold, found, k = Q_fold(r[0]), 0, 1
        copies.append((r[0], r[0]))
        while found < 9:
            new = r[0] + 1_000_000 * k
            if Q_fold(new) == fold:
                copies.append((r[0], new))
                found += 1
            k += 1
    ids = spark.createDataFrame(copies, "doc_id long, new_id long")
    many = docs.join(ids, "doc_id").select(F.col("new_id").alias("doc_id"), "text")
    many_labels = labels.join(ids, "doc_id").select(F.col("new_id").alias("doc_id"), "quality", "toxic")
    model, tenfold = Q.fit(docs, Q.training(labels)), Q.fit(many, Q.training(many_labels))
    assert max(abs(a - b) for a, b in zip(model, tenfold)) <= 1
    once, again = verdicts(docs, labels), verdicts(many, many_labels)
    changed = [i for i in once if once[i] != again[i]]
    assert len(changed) <= 1  # a score at the threshold to within a micro-unit's rounding
    assert sum(not k for f, k in once.values() if not f) > 0


def Q_fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % Q.FOLDS == 0


def test_without_both_held_out_classes_nothing_is_rejected(spark):
    docs = table(spark)
    one = spark.createDataFrame([(i, 1, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    assert all(r["kept"] != r["base_failed"] for r in Q.fit_judge(docs, one).collect())
    assert Q.fit_judge(docs.limit(0), one).count() == 0
    assert Q.fit_judge(docs, one.limit(0)).count() == docs.count()


def test_repeats_of_many_windows(spark):
    rows = [(1, "a b c d e " * 40), (2, "a b c d e f g a b c d e"), (3, "x " * 9), (4, "a b c d e a b c d e")]
    judged = Q.judge(table(spark, rows), [0] * 16).collect()
    for r in judged:
        assert tuple(r[f] for f in FIGURES) == base(r["row"]["text"])


def test_filter_on_the_verdict_stays_above_the_arrays(spark):
    """Pushed below, the array expressions would be evaluated once per element."""
    docs = table(spark, [(1, " ".join(f"w{i}" for i in range(30_000)))])
    assert Q.judge(docs, [0] * 16).where("kept").count() == 1


def test_every_trusted_text_makes_the_target(spark):
    """25,000 trusted texts, negative ids too: each counts, and no other."""
    labels = spark.range(-12_500, 12_500).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert Q.trusted_ids(labels).count() == 25_000
    docs = spark.range(-13_000, 13_000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    marked = Q.with_marks(docs, Q.trusted_ids(labels).withColumn("mark", F.lit(1)), "left")
    assert marked.where("(mark = 1) != (doc_id between -12500 and 12499)").count() == 0
    assert marked.where("mark is not null").count() == 25_000


def test_every_held_out_text_sets_the_threshold(spark):
    """A tenth of the good texts, all past the first 4,000 by id hash, score lower: the threshold falls to them."""
    held = spark.range(30_000).select(F.col("id").alias("doc_id")).where(Q.held_out())
    first = held.orderBy(F.xxhash64("doc_id"), "doc_id").limit(4000).withColumn("first", F.lit(1))
    model = [(bucket * 7919) % 1_000_003 for bucket in range(1 << 12)]
    one = lambda text: sum(model[bucket(h, 1 << 12)] for h in grams(text)) / len(grams(text))
    worst, low, high = sorted((" ".join(f"{w}{i}" for i in range(12)) for w in ("good", "less", "bad")), key=one)
    docs = held.join(first, "doc_id", "left").select("doc_id", F.when(F.col("first") == 1, high).otherwise(low).alias("text"))
    bad = spark.range(100_000, 101_000).select(F.col("id").alias("doc_id")).where(Q.held_out())
    docs = docs.union(bad.select("doc_id", F.lit(worst).alias("text")))
    labels = held.select("doc_id", F.lit(1).alias("quality")).union(bad.select("doc_id", F.lit(0)))
    assert Q.calibrate(docs, labels, model) == (math.floor(one(low)) + math.floor(one(worst))) // 2
