"""Streaming catalogue entries.

Each builder runs the pipeline stages it needs with ``availableNow`` triggers
(fresh sinks and checkpoints under the shared checkpoint folder) and returns a
batch DataFrame over the resulting sink.  The oracle SQL computes the same
result from the ``events`` table (event streams) or from the star view over
the sales tables (the sales-order CSV stream).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schema as S
from ledgerlens.fixtures import events_as_text, render_sales_csv, write_landing
from ledgerlens.operators.ranking import top_n
from ledgerlens.plans.oracle import EVENT_TIME as _EVENT_TIME_SQL
from ledgerlens.plans.oracle import SALES as _SALES_SQL
from ledgerlens.sources.star import sales_fact
from ledgerlens.sources.tables import read_table
from ledgerlens.streaming import pipeline as SP
from ledgerlens.streaming import sales as SL


def _bronze(spark: SparkSession, sf_dir: str, run: SP.StreamPaths) -> str:
    return SP.write_bronze(SP.events_source(spark, sf_dir), run)


def _silver(spark: SparkSession, sf_dir: str, run: SP.StreamPaths) -> str:
    return SP.write_silver(spark, _bronze(spark, sf_dir, run), run)


def q_stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = SP.new_run(spark, "bronze")
    bronze = _bronze(spark, sf_dir, run)
    return spark.read.schema(SP.BRONZE_SCHEMA).parquet(bronze).drop("event_date")


def q_stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = SP.new_run(spark, "silver")
    return SP.read_silver(spark, _silver(spark, sf_dir, run)).drop("event_date")


def _land(events: DataFrame, run: SP.StreamPaths) -> str:
    """One delivery of an event producer: part files added to the landing folder."""
    landing = run.sink("landing")
    events.write.mode("append").parquet(landing)
    return landing


def _deliver(spark: SparkSession, run: SP.StreamPaths, *deliveries: DataFrame) -> tuple[str, str]:
    """Land deliveries one by one, bronze and silver catching up after each."""
    for rows in deliveries:
        landing = _land(rows, run)
        bronze = SP.write_bronze(SP.events_source(spark, landing, file_glob="*.parquet"), run)
        silver = SP.write_silver(spark, bronze, run)
    return bronze, silver


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The later half of the events' time span, then the earlier one."""
    events = read_table(spark, sf_dir, "events")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    middle = F.lit((low + (high - low) / 2).isoformat(" ")).cast("timestamp_ntz")
    later = F.coalesce(F.col("ts") >= middle, F.lit(False))
    return events.where(later), events.where(~later)


def q_stream_replay_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An at-least-once producer: the same events are delivered twice.  Bronze
    keeps both copies; silver keeps one per ``event_id``."""
    run = SP.new_run(spark, "replay")
    events = read_table(spark, sf_dir, "events")
    _, silver = _deliver(spark, run, events, events)
    return SP.read_silver(spark, silver).drop("event_date")


def q_stream_dedup_across_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is delivered again a day later, its ``ts`` moved over midnight:
    silver keeps the first delivery's row."""
    run = SP.new_run(spark, "across-days")
    events = read_table(spark, sf_dir, "events")
    moved = events.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY"))
    _, silver = _deliver(spark, run, events, moved)
    return SP.read_silver(spark, silver).drop("event_date")


def q_stream_hourly_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows when the later half of the events arrives first."""
    run = SP.new_run(spark, "hourly-late")
    for half in _halves(spark, sf_dir):
        _, silver = _deliver(spark, run, half)
        hourly = SP.write_hourly(spark, silver, run)
    return SP.read_hourly(spark, hourly)


def q_stream_quarantine_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows of a delivery with a defect of every kind in its values."""
    run = SP.new_run(spark, "quarantine-defects")
    k = F.pmod(F.col("event_id"), F.lit(10))
    defective = read_table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        F.when(k == 2, F.lit("unheard of")).otherwise(F.col("event_type")).alias("event_type"),
        F.when(k == 3, F.lit(None)).when(k == 4, -1 - F.abs("value")).otherwise(F.col("value")).alias("value"),
        F.when(k == 5, F.lit("{")).otherwise(F.col("props")).alias("props"),
    )
    landing = _land(defective, run)
    bronze = SP.write_bronze(SP.events_source(spark, landing, file_glob="*.parquet"), run)
    return spark.read.schema(QUARANTINE_SCHEMA).parquet(SP.write_quarantine(spark, bronze, run))


QUARANTINE_SCHEMA = T.StructType(S.EVENTS_SCHEMA.fields + [T.StructField("reason", T.StringType(), True)])


def q_stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split of the events, row by row: rejected rows with their reason, silver's rows with none."""
    run = SP.new_run(spark, "quarantine")
    bronze = _bronze(spark, sf_dir, run)
    rejected = spark.read.schema(QUARANTINE_SCHEMA).parquet(SP.write_quarantine(spark, bronze, run))
    accepted = SP.read_silver(spark, SP.write_silver(spark, bronze, run))
    return rejected.union(accepted.select(*S.EVENTS_SCHEMA.names, F.lit(None).cast("string").alias("reason")))


def q_stream_quarantine_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text ingest: rejected records of a producer with content-dependent defects."""
    run = SP.new_run(spark, "quarantine-text")
    bronze = SP.write_text_bronze(events_as_text(SP.events_source(spark, sf_dir)), run)
    out = SP.write_text_quarantine(spark, bronze, run)
    return spark.read.schema(SP.QUARANTINE_TEXT_SCHEMA).parquet(out)


def q_stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = SP.new_run(spark, "hourly")
    silver = _silver(spark, sf_dir, run)
    hourly = SP.write_hourly(spark, silver, run)
    return SP.read_hourly(spark, hourly)


def q_stream_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = SP.new_run(spark, "serving")
    serving = SP.write_serving(spark, _silver(spark, sf_dir, run), sf_dir, run)
    latest = SP.read_serving(spark, serving)
    return top_n(latest, 20, [F.desc("total_value"), F.asc("region"), F.asc("event_type")])


def _sales_landing(spark: SparkSession, sf_dir: str, run: SP.StreamPaths) -> str:
    """The producer side: the sales fact landed as CSV text in the run folder."""
    return write_landing(sales_fact(spark, sf_dir, S.SALES_COLUMNS), run.sink("landing"))


def q_stream_sales_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales CSV stream: lenient parsing, event time, hourly revenue windows."""
    run = SP.new_run(spark, "sales-hourly")
    silver = SL.write_sales_silver(spark, _sales_landing(spark, sf_dir, run), run)
    hourly = SL.write_sales_hourly(spark, silver, run)
    return SL.read_sales_hourly(spark, hourly)


def q_stream_sales_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly revenue of a sales stream whose later half arrives first."""
    run = SP.new_run(spark, "sales-late")
    sales = sales_fact(spark, sf_dir, S.SALES_COLUMNS)
    later = F.col(S.ORDER_DATE) >= F.lit("1995-07-01").cast("timestamp_ntz")
    for half in (sales.where(later), sales.where(~later)):
        render_sales_csv(half).write.mode("append").option("header", True).csv(run.sink("landing"))
        silver = SL.write_sales_silver(spark, run.sink("landing"), run)
        hourly = SL.write_sales_hourly(spark, silver, run)
    return SL.read_sales_hourly(spark, hourly)


def q_stream_sales_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales CSV stream: rows whose order date does not parse."""
    run = SP.new_run(spark, "sales-quarantine")
    out = SL.write_sales_quarantine(spark, _sales_landing(spark, sf_dir, run), run)
    return spark.read.schema(SL.QUARANTINE_SALES_SCHEMA).parquet(out)


def q_stream_sales_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales CSV stream: region x item type serving table, top 20 by profit."""
    run = SP.new_run(spark, "sales-serving")
    silver = SL.write_sales_silver(spark, _sales_landing(spark, sf_dir, run), run)
    return SL.read_sales_serving(spark, SL.write_sales_serving(spark, silver, run), 20)


STREAM_QUERIES = {
    "stream_bronze": q_stream_bronze,
    "stream_silver": q_stream_silver,
    "stream_replay_dedup": q_stream_replay_dedup,
    "stream_dedup_across_days": q_stream_dedup_across_days,
    "stream_quarantine": q_stream_quarantine,
    "stream_quarantine_text": q_stream_quarantine_text,
    "stream_quarantine_defects": q_stream_quarantine_defects,
    "stream_hourly": q_stream_hourly,
    "stream_hourly_two_batches": q_stream_hourly_two_batches,
    "stream_serving": q_stream_serving,
    "stream_sales_hourly": q_stream_sales_hourly,
    "stream_sales_two_batches": q_stream_sales_two_batches,
    "stream_sales_quarantine": q_stream_sales_quarantine,
    "stream_sales_serving": q_stream_sales_serving,
}

_VALID = """event_id IS NOT NULL AND ts IS NOT NULL
  AND lower(trim(event_type)) IN ('view', 'click', 'signup', 'purchase', 'error')
  AND value IS NOT NULL AND NOT isnan(value) AND value >= 0
  AND TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NOT NULL"""

_SILVER = f"""silver AS (
  SELECT event_id, ts, user_id, lower(trim(event_type)) AS event_type, value, props,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events WHERE {_VALID}
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts) = 1)"""

# Order date as the stream parses it: low-priority orders were landed day-first,
# which parses to the swapped date when the day is at most 12 and fails otherwise.
_LANDED_DATE = """CASE WHEN order_priority = '5-LOW' THEN
           CASE WHEN day(order_date) <= 12
                THEN make_timestamp(year(order_date), day(order_date), month(order_date), 0, 0, 0) END
         ELSE order_date END"""

_DEFECTS = """SELECT event_id, ts, user_id,
         CASE WHEN event_id % 10 = 2 THEN 'unheard of' ELSE event_type END AS event_type,
         CASE event_id % 10 WHEN 3 THEN NULL WHEN 4 THEN -1 - abs(value) ELSE value END AS value,
         CASE WHEN event_id % 10 = 5 THEN '{' ELSE props END AS props FROM events"""

_REJECTED = """SELECT * FROM (
  SELECT event_id, ts, user_id, event_type, value, props,
         CASE WHEN event_id IS NULL THEN 'missing event_id'
              WHEN ts IS NULL THEN 'missing ts'
              WHEN lower(trim(event_type)) IS NULL
                OR lower(trim(event_type)) NOT IN ('view', 'click', 'signup', 'purchase', 'error')
                THEN 'unknown event_type'
              WHEN value IS NULL OR isnan(value) THEN 'missing value'
              WHEN value < 0 THEN 'negative value'
              WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NULL
                THEN 'malformed props'
         END AS reason
  FROM events) t
WHERE reason IS NOT NULL"""

STREAM_ORACLE_SQL = {
    "stream_bronze": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "stream_silver": f"WITH {_SILVER} SELECT * FROM silver",
    "stream_replay_dedup": f"WITH {_SILVER} SELECT * FROM silver",
    "stream_dedup_across_days": f"WITH {_SILVER} SELECT * FROM silver",
    "stream_quarantine": f"""WITH {_SILVER}, rejected AS ({_REJECTED})
SELECT event_id, ts, user_id, event_type, value, props, reason FROM rejected
UNION ALL SELECT event_id, ts, user_id, event_type, value, props, NULL FROM silver""",
    "stream_quarantine_text": """WITH raw AS (
  SELECT event_id, ts, user_id,
         CASE WHEN event_type = 'signup' THEN ' SIGNUP ' ELSE event_type END AS event_type,
         CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS value_text,
         CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) >= 95
              THEN 'k=' || json_extract_string(props, '$.k') ELSE props END AS props
  FROM events),
typed AS (
  SELECT *, TRY_CAST(trim(value_text) AS DOUBLE) AS v FROM raw)
SELECT * FROM (
  SELECT event_id, ts, user_id, event_type, value_text, props,
         CASE WHEN event_id IS NULL THEN 'missing event_id'
              WHEN ts IS NULL THEN 'missing ts'
              WHEN lower(trim(event_type)) IS NULL
                OR lower(trim(event_type)) NOT IN ('view', 'click', 'signup', 'purchase', 'error')
                THEN 'unknown event_type'
              WHEN v IS NULL OR isnan(v) THEN 'missing value'
              WHEN v < 0 THEN 'negative value'
              WHEN NOT json_valid(props)
                OR TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NULL
                THEN 'malformed props'
         END AS reason
  FROM typed) t
WHERE reason IS NOT NULL""",
    "stream_sales_hourly": f"""WITH {_SALES_SQL},
landed AS (SELECT order_id, total_revenue, units_sold, {_LANDED_DATE} AS order_date FROM sales),
timed AS (SELECT {_EVENT_TIME_SQL} AS et, total_revenue, units_sold FROM landed WHERE order_date IS NOT NULL)
SELECT time_bucket(INTERVAL '1 hour', et, TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL '1 hour', et, TIMESTAMP '1970-01-01') + INTERVAL '1 hour' AS window_end,
       count(*) AS lines,
       CAST(sum(total_revenue) AS DOUBLE) AS total_revenue,
       CAST(sum(units_sold) AS DOUBLE) AS units_sold
FROM timed GROUP BY 1, 2""",
    "stream_sales_serving": f"""WITH {_SALES_SQL},
landed AS (SELECT region, item_type, total_revenue, total_profit, units_sold,
                  {_LANDED_DATE} AS landed_date FROM sales)
SELECT region, item_type,
       CAST(sum(total_revenue) AS DOUBLE) AS total_revenue,
       CAST(sum(total_profit) AS DOUBLE) AS total_profit,
       CAST(sum(units_sold) AS DOUBLE) AS units_sold
FROM landed WHERE landed_date IS NOT NULL
GROUP BY region, item_type
ORDER BY total_profit DESC, region, item_type LIMIT 20""",
    "stream_sales_quarantine": f"""WITH {_SALES_SQL}
SELECT order_id, strftime(order_date, '%-d/%-m/%Y') AS order_date_text,
       'unparsable order date' AS reason
FROM sales WHERE order_priority = '5-LOW' AND day(order_date) > 12""",
    "stream_hourly": f"""WITH {_SILVER}
SELECT time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') + INTERVAL '1 hour' AS window_end,
       count(*) AS events,
       CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_value
FROM silver GROUP BY 1, 2""",
    "stream_serving": f"""WITH {_SILVER}
SELECT r.r_name AS region, s.event_type, count(*) AS events,
       CAST(sum(CAST(s.value AS DECIMAL(12,2))) AS DOUBLE) AS total_value
FROM silver s
LEFT JOIN customer c ON s.user_id = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 1, 2 ORDER BY total_value DESC, region, event_type LIMIT 20""",
}

STREAM_ORACLE_SQL["stream_hourly_two_batches"] = STREAM_ORACLE_SQL["stream_hourly"]
STREAM_ORACLE_SQL["stream_sales_two_batches"] = STREAM_ORACLE_SQL["stream_sales_hourly"]
STREAM_ORACLE_SQL["stream_quarantine_defects"] = (
    _REJECTED
    .replace("FROM events) t", f"FROM ({_DEFECTS}) e) t")
    .replace("WHEN TRY_CAST(", "WHEN NOT json_valid(props) OR TRY_CAST(")
)
