"""Structured Streaming pipeline: raw append (bronze), validation with a
quarantine (silver), windowed KPIs and a serving table.

    events source --append--> bronze (parquet, partitioned by event date)
    bronze --stream--> silver      valid rows, trimmed, one row per event id
    bronze --stream--> quarantine  rejected rows with the first failed rule
    silver --stream--> hourly      1-hour event-time windows, changed windows per batch
    silver --stream--> serving     region x event type, changed rows per batch

No watermark: every valid row reaches silver, the windows and the serving
table whatever the order of delivery (a backfill comes in file order, and sales
dates span years).  State lives in Spark's state store: silver keeps the event
ids it has seen, so a repeat counts once whatever its day; windows and serving
rows are keyed sums, one per hour of the calendar or per key.  ``cluster_conf``
puts the store into RocksDB, so state is bounded by disk, not by heap.

Bronze, silver and quarantine are file sinks: a batch that runs again after a
crash adds no file that a reader or a downstream stream would see.  Sums are
written in update mode: each batch puts the rows it changed into a folder of
its own, which a replay overwrites with the same rows, and readers take each
key's latest batch.  Sales orders as a CSV stream live in
``ledgerlens.streaming.sales``.

Checkpoints and sinks live under the shared folder named by
``spark.checkpoint.dir`` (``ledgerlens.session.checkpoint_root``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schema as S
from ledgerlens.session import scratch_path
from ledgerlens.sources.tables import read_table

# Fixed validation rules of the silver layer.
KNOWN_EVENT_TYPES = ["view", "click", "signup", "purchase", "error"]
VALUE_TYPE = T.DecimalType(12, 2)
#: Tasks that a day's silver rows are dealt to, and copies of a user's dimension row.
DAY_SPREAD, USER_SALTS = 4, 4

BRONZE_SCHEMA = T.StructType(S.EVENTS_SCHEMA.fields + [T.StructField("event_date", T.DateType(), True)])
SILVER_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props", "k", "event_date"]


@dataclass(frozen=True)
class StreamPaths:
    """Sink and checkpoint folders of one pipeline run."""

    root: str

    def sink(self, name: str) -> str:
        return f"{self.root}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"


def new_run(spark: SparkSession, name: str = "stream") -> StreamPaths:
    return StreamPaths(scratch_path(spark, name))


def events_source(
    spark: SparkSession,
    source_dir: str,
    file_glob: str | None = "events.parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming scan of the events parquet files under ``source_dir``."""
    reader = spark.readStream.schema(S.EVENTS_SCHEMA)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(source_dir)


def _run(writer) -> None:
    """Start an ``availableNow`` query and wait until it has drained its input."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:  # surfaced by awaitTermination on most versions
        raise RuntimeError(str(query.exception()))


def append_sink(rows: DataFrame, paths: StreamPaths, name: str, partition_by: str | None = None) -> str:
    """Append a stream to a file sink until its input is drained.

    The sink's log lists the files of committed batches; readers and
    downstream streams see those only, so a batch that runs twice counts once.
    """
    out = paths.sink(name)
    writer = (
        rows.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", paths.checkpoint(name))
        .outputMode("append")
    )
    _run(writer.partitionBy(partition_by) if partition_by else writer)
    return out


def write_changes(sums: DataFrame, paths: StreamPaths, name: str, schema: T.StructType) -> str:
    """Keep the keyed sums of a stream (``outputMode("update")``) in a table of changes.

    A batch writes the rows it changed to its own folder, as whole sums from
    the state store.  A batch that runs again starts from the same state and
    replaces its folder.
    """
    out = paths.sink(name)
    sums.sparkSession.createDataFrame([], schema).write.mode("ignore").parquet(f"{out}/batch=-1")

    def put(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    _run(
        sums.writeStream.outputMode("update")
        .option("checkpointLocation", paths.checkpoint(name))
        .foreachBatch(put)
    )
    return out


def read_changes(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The latest row of each key."""
    stored = T.StructType(schema.fields + [T.StructField("batch", T.LongType(), True)])
    rows = spark.read.schema(stored).parquet(path)
    sums = F.struct(*[c for c in schema.names if c not in keys])
    return rows.groupBy(*keys).agg(F.max_by(sums, "batch").alias("_latest")).select(*keys, "_latest.*")


# ---------------------------------------------------------------- bronze


def bronze_rows(events: DataFrame) -> DataFrame:
    return events.withColumn("event_date", F.to_date("ts"))


def write_bronze(events: DataFrame, paths: StreamPaths) -> str:
    """Raw append of the event stream, partitioned by event date."""
    return append_sink(bronze_rows(events), paths, "bronze", "event_date")


def read_bronze_stream(spark: SparkSession, bronze: str) -> DataFrame:
    return spark.readStream.schema(BRONZE_SCHEMA).parquet(bronze)


# ---------------------------------------------------------------- silver / quarantine


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").try_cast("int")


def rejection_reason(df: DataFrame) -> Column:
    """First failed rule, or null for a valid row (checked in this order)."""
    etype = F.lower(F.trim(F.col("event_type")))
    return (
        F.when(F.col("event_id").isNull(), F.lit("missing event_id"))
        .when(F.col("ts").isNull(), F.lit("missing ts"))
        .when(etype.isNull() | ~etype.isin(KNOWN_EVENT_TYPES), F.lit("unknown event_type"))
        .when(F.col("value").isNull() | F.isnan("value"), F.lit("missing value"))
        .when(F.col("value") < 0, F.lit("negative value"))
        .when(_k(F.col("props")).isNull(), F.lit("malformed props"))
    )


def silver_rows(bronze: DataFrame) -> DataFrame:
    """Valid rows, event type normalised, ``k`` parsed."""
    valid = bronze.where(rejection_reason(bronze).isNull())
    return valid.withColumns(
        {"event_type": F.lower(F.trim(F.col("event_type"))), "k": _k(F.col("props"))}
    ).select(*SILVER_COLUMNS)


def quarantine_rows(bronze: DataFrame) -> DataFrame:
    reason = rejection_reason(bronze)
    return bronze.where(reason.isNotNull()).select(*S.EVENTS_SCHEMA.names, reason.alias("reason"))


# ---------------------------------------------------------------- text ingest

TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TEXT_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType(), True) for name in S.EVENTS_SCHEMA.names]
    + [T.StructField("event_date", T.DateType(), True)]
)


def parse_event_text(raw: DataFrame) -> DataFrame:
    """Typed events from text; unparsable fields become null (``try_*``)."""
    return raw.select(
        F.trim("event_id").try_cast("bigint").alias("event_id"),
        F.try_to_timestamp(F.col("ts"), F.lit(TS_TEXT_FORMAT)).cast(T.TimestampNTZType()).alias("ts"),
        F.trim("user_id").try_cast("bigint").alias("user_id"),
        "event_type",
        F.trim("value").try_cast("double").alias("value"),
        "props",
        F.col("value").alias("value_text"),
        "event_date",
    )


def write_text_bronze(records: DataFrame, paths: StreamPaths) -> str:
    """Raw append of text records (``TEXT_SCHEMA``), partitioned by event date."""
    return append_sink(records, paths, "bronze_text", "event_date")


def text_quarantine_rows(raw: DataFrame) -> DataFrame:
    """Rejected text records: parsed key fields, raw value and props, reason."""
    typed = parse_event_text(raw)
    reason = rejection_reason(typed)
    return typed.where(reason.isNotNull()).select(
        "event_id", "ts", "user_id", "event_type", "value_text", "props", reason.alias("reason")
    )


def write_text_quarantine(spark: SparkSession, bronze_text: str, paths: StreamPaths) -> str:
    raw = spark.readStream.schema(TEXT_SCHEMA).parquet(bronze_text)
    return append_sink(text_quarantine_rows(raw), paths, "quarantine_text")


def write_text_silver(spark: SparkSession, bronze_text: str, paths: StreamPaths) -> str:
    """Silver from text records: parse, validate, normalise, deduplicate."""
    typed = parse_event_text(spark.readStream.schema(TEXT_SCHEMA).parquet(bronze_text))
    return _write_silver(silver_rows(typed.drop("value_text")), paths, "silver_text")


QUARANTINE_TEXT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType(), True),
        T.StructField("ts", T.TimestampNTZType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("value_text", T.StringType(), True),
        T.StructField("props", T.StringType(), True),
        T.StructField("reason", T.StringType(), True),
    ]
)


def first_of_each(rows: DataFrame, keys: list[str], day: str) -> DataFrame:
    """The first row of each key, whatever its day; later ones are dropped by the state store.

    Rows are then dealt out by day, so a batch writes a file or a few per day;
    a heavy day goes to ``DAY_SPREAD`` tasks.  Of repeats within one batch any
    one stays.
    """
    spread = F.pmod(F.xxhash64(*keys), F.lit(DAY_SPREAD))
    return rows.dropDuplicates(keys).repartition(F.col(day), spread)


def _write_silver(rows: DataFrame, paths: StreamPaths, name: str) -> str:
    return append_sink(first_of_each(rows, ["event_id"], "event_date"), paths, name, "event_date")


def write_silver(spark: SparkSession, bronze: str, paths: StreamPaths) -> str:
    return _write_silver(silver_rows(read_bronze_stream(spark, bronze)), paths, "silver")


def write_quarantine(spark: SparkSession, bronze: str, paths: StreamPaths) -> str:
    return append_sink(quarantine_rows(read_bronze_stream(spark, bronze)), paths, "quarantine")


SILVER_SCHEMA = T.StructType(
    [f for f in S.EVENTS_SCHEMA.fields]
    + [T.StructField("k", T.IntegerType(), True), T.StructField("event_date", T.DateType(), True)]
)


def read_silver_stream(spark: SparkSession, silver: str) -> DataFrame:
    return spark.readStream.schema(SILVER_SCHEMA).parquet(silver).select(*SILVER_SCHEMA.names)


def read_silver(spark: SparkSession, silver: str) -> DataFrame:
    return spark.read.schema(SILVER_SCHEMA).parquet(silver).select(*SILVER_SCHEMA.names)


# ---------------------------------------------------------------- windowed KPIs

WINDOW_START = T.StructField("window_start", T.TimestampNTZType(), True)


def with_window_end(hours: DataFrame) -> DataFrame:
    """Adds the end of one-hour windows after their start."""
    others = [c for c in hours.columns if c != "window_start"]
    return hours.select(
        "window_start", (F.col("window_start") + F.expr("INTERVAL 1 HOUR")).alias("window_end"), *others
    )


HOURLY_SCHEMA = T.StructType(
    [
        WINDOW_START,
        T.StructField("events", T.LongType(), True),
        T.StructField("total_value", T.DecimalType(38, 2), True),
    ]
)


def hourly_sums(silver: DataFrame) -> DataFrame:
    """Event count and exact value sum by event-time hour (its start)."""
    sums = silver.groupBy(F.window("ts", "1 hour").alias("w")).agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast(VALUE_TYPE)).alias("total_value")
    )
    return sums.select(
        F.col("w.start").alias("window_start"), "events", F.col("total_value").cast("decimal(38,2)").alias("total_value")
    )


def hourly_kpis(silver: DataFrame) -> DataFrame:
    """The hourly windows of a batch frame."""
    return with_window_end(hourly_sums(silver)).withColumn("total_value", F.col("total_value").cast("double"))


def write_hourly(spark: SparkSession, silver: str, paths: StreamPaths) -> str:
    """Hourly windows kept by a stateful stream: late rows add to their window.

    The state holds one row per hour of the calendar, whatever the event
    volume, and a batch writes the hours it changed.
    """
    return write_changes(hourly_sums(read_silver_stream(spark, silver)), paths, "hourly", HOURLY_SCHEMA)


def read_hourly(spark: SparkSession, hourly: str) -> DataFrame:
    latest = read_changes(spark, hourly, HOURLY_SCHEMA, ["window_start"])
    return with_window_end(latest).withColumn("total_value", F.col("total_value").cast("double"))


# ---------------------------------------------------------------- serving table


def user_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static dimension user (customer) -> region name."""
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("user_id"), F.col("r_name").alias("region")
    )


def co_partitioned_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user -> region dimension, each row once per salt, hash-partitioned by
    (user, salt) into the session's shuffle partition count, sorted and persisted.

    The cache is materialised at once (one count): its layout is only known to
    the planner after that, and from then on a sort-merge join on the two
    columns reuses it as it is - no exchange and no sort on this side in any
    micro-batch.  The caller unpersists it when done.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    salts = F.explode(F.array(*[F.lit(i) for i in range(USER_SALTS)]))
    users = (
        user_regions(spark, sf_dir)
        .withColumn("salt", salts)
        .repartition(partitions, "user_id", "salt")
        .sortWithinPartitions("user_id", "salt")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    users.count()
    return users


SERVING_KEYS = ["region", "event_type"]
SERVING_SCHEMA = T.StructType(
    [T.StructField(k, T.StringType(), True) for k in SERVING_KEYS]
    + [T.StructField("events", T.LongType(), True), T.StructField("total_value", T.DecimalType(38, 2), True)]
)


def serving_sums(events: DataFrame, users: DataFrame) -> DataFrame:
    """Events and exact value per (region, event type); users without a known
    region keep a null region.

    ``users`` holds each user once per salt (``co_partitioned_users``): a user
    with a large share of the events meets ``USER_SALTS`` tasks.  The sums run
    map-side first, so a hot region reaches the state as a few rows.
    """
    salt = F.pmod(F.xxhash64("event_id"), F.lit(USER_SALTS)).cast("int")
    rows = events.select("user_id", "event_type", "value", salt.alias("salt"))
    joined = rows.join(users, ["user_id", "salt"], "left")
    sums = joined.groupBy(*SERVING_KEYS).agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast(VALUE_TYPE)).alias("total_value")
    )
    return sums.withColumn("total_value", F.col("total_value").cast("decimal(38,2)"))


def write_serving(spark: SparkSession, silver: str, sf_dir: str, paths: StreamPaths) -> str:
    """Serving table kept by a stateful stream joined to the static user dimension.

    The state has one row per (region, event type), and a batch writes the rows
    it changed.  The dimension is laid out once while the stream runs; a lost
    executor's blocks are recomputed from the lineage.
    """
    users = co_partitioned_users(spark, sf_dir)
    try:
        return write_changes(serving_sums(read_silver_stream(spark, silver), users), paths, "serving", SERVING_SCHEMA)
    finally:
        users.unpersist()


def read_serving(spark: SparkSession, serving: str) -> DataFrame:
    latest = read_changes(spark, serving, SERVING_SCHEMA, SERVING_KEYS)
    return latest.withColumn("total_value", F.col("total_value").cast("double"))


def run_pipeline(
    spark: SparkSession,
    source_dir: str,
    dims_dir: str | None = None,
    paths: StreamPaths | None = None,
    max_files_per_trigger: int | None = None,
    file_glob: str | None = "events.parquet",
) -> dict[str, str]:
    """Run every stage once (``availableNow``) and return the sink folders.

    ``file_glob`` selects the event files in ``source_dir`` (the driver layout
    has one ``events.parquet``; a landing folder of part files uses
    ``"*.parquet"``).  Re-running with the same ``paths`` continues from the
    checkpoints and only processes files that arrived since.
    """
    paths = paths or new_run(spark, "pipeline")
    events = events_source(
        spark, source_dir, file_glob=file_glob, max_files_per_trigger=max_files_per_trigger
    )
    bronze = write_bronze(events, paths)
    silver = write_silver(spark, bronze, paths)
    return {
        "bronze": bronze,
        "silver": silver,
        "quarantine": write_quarantine(spark, bronze, paths),
        "hourly": write_hourly(spark, silver, paths),
        "serving": write_serving(spark, silver, dims_dir or source_dir, paths),
    }
