"""Corpus pipeline: documents to packed training sequences.

Each stage takes the rows its predecessor kept, written as Parquet and read
again, and all but the last return the columns of ``documents``.

Defined cases, for every stage: a null text counts as the empty one, which the
base rules of the first stage reject; a null id is kept as it is; repeated rows
are exact copies, of which one stays; an empty table gives an empty table;
further columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import fuse_exact, kk_packing, quality_llr, rlbwt, simhash_ring
from ledgerlens.llm.common import documents, scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the likelihood ratio reject go."""
    return quality_llr.fit_judge(docs, quality_llr.labels_of(spark, sf_dir)).where("kept").select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return fuse_exact.keep_first(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash_ring.keep_one(docs)


#: A passage is what occurs again and holds more than 50 words; found by its
#: bytes first, of which 50 words of three letters and a space have 200.
PASSAGE_WORDS, PASSAGE_BYTES, PASSAGE_GRAM = 51, 200, 40


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out of the texts, the first occurrence like the others; every document stays."""
    return rlbwt.remove(docs, length=PASSAGE_BYTES, gram=PASSAGE_GRAM, least_words=PASSAGE_WORDS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in near-equal sequences, one row per piece."""
    return kk_packing.pack(docs)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("suffix_dedup", suffix_dedup),
    ("packing", packing),
]

#: Fingerprints, suffix matches and token ids can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
