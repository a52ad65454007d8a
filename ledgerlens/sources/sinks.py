"""Writing results: a query result stays a DataFrame until a sink persists it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
) -> str:
    """Persist a result as files (parquet, json, csv, ...) under ``path``.

    Partitioning by a low-cardinality column (a date, a year) lets later reads
    prune whole folders.  Executors write in parallel; nothing passes through
    the driver.
    """
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path
