"""A denormalised copy of the sales fact for repeated dashboard queries.

The star view joins five dimensions on every query.  When many queries run
over the same data, the joins can be paid once: ``materialize_fact`` writes
the fact to the shared folder, partitioned by order year (year selections then
prune whole folders) and optionally bucketed by order id through a catalogue
table (joins and aggregations keyed on the order id then need no shuffle).
The operators accept the copy exactly like the view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schema as S
from ledgerlens.session import scratch_path
from ledgerlens.sources.star import sales_fact

ORDER_YEAR = "order_year"


def fact_schema(spark: SparkSession, sf_dir: str) -> T.StructType:
    return sales_fact(spark, sf_dir).schema


def materialize_fact(
    spark: SparkSession,
    sf_dir: str,
    path: str | None = None,
    buckets: int | None = None,
    table: str | None = None,
    partition_by: str = ORDER_YEAR,
) -> DataFrame:
    """Write the full fact once and return a reader over the written copy.

    ``partition_by`` may name another column of few values: with the region, a
    chosen region prunes the other regions' folders at run time.
    """
    path = path or scratch_path(spark, "sales_fact")
    fact = sales_fact(spark, sf_dir).withColumn(ORDER_YEAR, F.year(S.ORDER_DATE))
    writer = fact.write.mode("overwrite").format("parquet").partitionBy(partition_by)
    if buckets and table:
        writer.bucketBy(buckets, S.ORDER_ID).sortBy(S.ORDER_ID).option("path", path).saveAsTable(table)
        return spark.table(table)
    writer.save(path)
    return read_fact(spark, path, fact_schema(spark, sf_dir))


def read_fact(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a materialised fact; ``order_year`` comes from the folder names."""
    full = T.StructType(schema.fields + [T.StructField(ORDER_YEAR, T.IntegerType(), True)])
    return spark.read.schema(full).parquet(path)


def count_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a materialised fact from its files' footers: no column is read.

    The count is pushed into the scan, which the second version of Spark's file
    sources does; a session of its own keeps that setting from other reads.
    """
    apart = spark.newSession()
    apart.conf.set("spark.sql.sources.useV1SourceList", "")
    apart.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return apart.read.schema(schema).parquet(path).agg(F.count(F.lit(1)).alias("rows"))
