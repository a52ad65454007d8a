"""Helpers shared by the training-data operators: tables, row keys, scratch tables."""

from __future__ import annotations

import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import scratch_path

# White space of the operators' contracts: space and the five controls 09-0D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(name: str = "text") -> Column:
    """The text column, a null text as the empty one."""
    return F.coalesce(F.col(name), F.lit(""))


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, rk, text`` of every row; ``rk`` is a hash of the text.

    ``(doc_id, rk)`` finds a row again in a second scan without relying on the
    order or the partitions of the first, also when ids are null or repeated.
    Rows equal in both are the same text under the same id, and every operator
    gives them equal results.
    """
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text_of()).alias("rk"),
        text_of().alias("text"),
    )


def same_row(a: DataFrame, b: DataFrame) -> Column:
    """Join condition on the row key; null ids match null ids."""
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["rk"] == b["rk"])


def write_scratch(df: DataFrame, name: str) -> str:
    """Write ``df`` as Parquet in the shared scratch folder; returns the path.

    Cuts the lineage: a lost executor costs no recomputation of what is
    written.  The folder goes when the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def scratch(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again."""
    return df.sparkSession.read.schema(df.schema).parquet(write_scratch(df, name))


def drop_scratch(df: DataFrame) -> None:
    """Delete the files of a scratch table that no later step reads."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now.

    Spark drops them when the driver collects the frames that made them, which
    may be long after a multi-step operator needs the disk.
    """
    gc.collect()
    spark._jvm.System.gc()


def keep_rows(docs: DataFrame, keys: DataFrame, repeated: bool) -> DataFrame:
    """The rows of ``docs`` whose row key is in ``keys`` (doc_id, rk, distinct), columns as given.

    ``repeated`` says that a key may stand for several equal rows, of which one
    stays.
    """
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text_of()).alias("rk"),
    )
    kept = rows.join(keys, same_row(rows, keys), "left_semi")
    if repeated:
        kept = kept.dropDuplicates(["doc_id", "rk"])
    return kept.select("row.*")


#: A key that holds more than one row of so many is joined on its own.
HOT_SHARE = 1000


def join_counted(rows: DataFrame, side: DataFrame, on: list[str], n: str, total: int, how: str = "inner") -> DataFrame:
    """Join rows to ``side``, one row per key with the number ``n`` of its rows, out of ``total``.

    A key may hold a third of all rows.  Those that hold over 1 in
    ``HOT_SHARE`` are fewer than ``HOT_SHARE``: they go to all tasks, and their
    rows stay where they are.  All others are joined by a shuffle.
    """
    hot = F.broadcast(side.where(F.col(n) * HOT_SHARE > total))  # fewer than HOT_SHARE rows
    cold = side.where(F.col(n) * HOT_SHARE <= total)
    rest = rows.join(hot.select(*on), on, "left_anti")
    return rows.join(hot, on, how).unionByName(rest.join(cold, on, how))


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, without decoding them."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def id_midpoint(docs: DataFrame) -> int:
    """The middle of the id range: splits a table into an older and a newer half."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    return 0 if low is None else (int(low) + int(high)) // 2


def is_older(middle: int) -> Column:
    """Rows of the older half; a null id counts as new."""
    return F.coalesce(F.col("doc_id") <= middle, F.lit(False))
