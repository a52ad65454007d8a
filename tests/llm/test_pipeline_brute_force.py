"""The pipeline's rows against a plain reading of each stage's rules."""

import math
import re
import zlib
from collections import Counter

import corpus_pipeline as P
import numpy as np
from conftest import SF0001
from helpers import table
from ledgerlens.llm import quality_llr as Q
from ledgerlens.llm.common import documents
from test_kk_packing import check
from test_quality_llr import base, bucket, grams
from test_simhash_ring import fingerprint, groups


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % Q.FOLDS == 0


def good_texts(rows, labels):
    """Documents that the base rules and the likelihood ratio keep."""
    quality, toxic = {}, {}
    for i, q, t in labels:
        quality[i] = min(q, quality.get(i, q))
        toxic[i] = max(t or 0, toxic.get(i, 0))
    hashed = {i: [bucket(h, Q.BUCKETS) for h in grams(t)] for i, t in rows.items()}
    raw = Counter(b for own in hashed.values() for b in own)
    target = Counter()
    for i, own in hashed.items():
        if quality.get(i) == 1 and not toxic[i] and not held(i):
            target.update(own)
    n_raw, n_target = sum(raw.values()), sum(target.values())
    prior = Q.PRIOR_SHARE * n_target
    ratio = {b: 0 for b in raw}
    if n_target:
        for b, n in raw.items():
            share = n / n_raw
            ratio[b] = round(1e6 * math.log((target[b] + prior * share) / (n_target + prior) / share))
    passed = {i for i, t in rows.items() if not base(t)[5]}
    score = {i: sum(ratio[b] for b in hashed[i]) / len(hashed[i]) for i in passed}
    good, bad = ([score[i] for i in passed if quality.get(i) == c and held(i)] for c in (1, 0))
    threshold = -math.inf
    if good and bad:
        low = np.quantile(good, Q.GOOD_LOST)
        threshold = math.floor(min(low, (low + np.median(bad)) / 2))
    return {i: rows[i] for i in passed if score[i] >= threshold}


def first_copies(rows):
    kept = {}
    for i in sorted(rows):
        kept.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[i] or ""), i)
    return {i: rows[i] for i in kept.values()}


def one_per_group(rows):
    prints = {i: fingerprint(t) for i, t in rows.items()}
    root = groups(set(prints.values()), 2)
    least = {}
    for i, f in prints.items():
        least[root[f]] = min(i, least.get(root[f], i))
    return {i: rows[i] for i in least.values()}


def without_passages(rows):
    data = {i: (t or "").encode() for i, t in rows.items()}
    n = P.PASSAGE_BYTES
    found = Counter(t[p : p + n] for t in data.values() for p in range(len(t) - n + 1))
    out = {}
    for i, t in data.items():
        gone = np.zeros(len(t) + 1, int)
        for p in range(len(t) - n + 1):
            if found[t[p : p + n]] > 1:
                gone[p : p + n] = 1
        edges = np.flatnonzero(np.diff(gone, prepend=0))
        kept, at = b"", 0
        for a, b in zip(edges[::2], edges[1::2]):
            if len(t[a:b].split()) >= P.PASSAGE_WORDS:
                kept, at = kept + t[at:a], b
        out[i] = (kept + t[at:]).decode(errors="ignore")
    return out


PLAIN = (good_texts, first_copies, one_per_group, without_passages)


def planted(rows):
    """The table's rows, and copies, near copies and passages among them."""
    rows = dict(rows)
    sound = [i for i, t in rows.items() if len((t or "").split()) > 200][:12]
    top = max(rows) + 1
    words = [rows[i].split() for i in sound]
    rows[top] = rows[sound[0]]
    rows[top + 1] = re.sub(" ", "  ", rows[sound[1]])
    longest = max((t for t in rows.values() if t), key=len)
    for k in range(4):  # near copies: a few of very many shingles differ
        rows[top + 20 + k] = f"{longest} {k} word more"
    for k in range(3):
        rows[top + 10 + k] = " ".join(words[3 + k][:100] + words[6][60:130] + words[7 + k][100:190])
    return rows


def test_stages_and_run_against_plain_rules(spark, tmp_path):
    docs = documents(spark, SF0001)
    rows = planted({r["doc_id"]: r["text"] for r in docs.collect()})
    made = [(i, t, "en", "src", len(t or "")) for i, t in rows.items()]
    folder = str(tmp_path)
    spark.createDataFrame(made, docs.schema).write.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{SF0001}/labels.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    current = documents(spark, folder)
    known = [(r["doc_id"], r["quality"], r["toxic"]) for r in labels.collect()]
    sizes = [len(rows)]
    for (name, stage), plain in zip(P.STAGES, PLAIN):
        rows = plain(rows, known) if plain is good_texts else plain(rows)
        current = stage(spark, current, folder).cache()
        assert {r["doc_id"]: r["text"] for r in current.collect()} == rows, name
        sizes.append(len(rows))
    assert sizes[1] < sizes[0] and sizes[2] <= sizes[1] - 2 and sizes[3] < sizes[2]
    # every id of what is left, once, in sequences of at most 1024
    check(P.run(spark, folder).collect(), table(spark, list(rows.items())))
