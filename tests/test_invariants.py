"""Cross-query invariants at sf0.01 (sums add up, stream = batch)."""

import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF001
from ledgerlens import schema as S
from ledgerlens.fixtures import events_as_text, write_landing
from ledgerlens.operators import paging as PG
from ledgerlens.plans.catalog import PAGE_COLUMNS
from ledgerlens.functions.calendar import event_time
from ledgerlens.sources.star import sales_fact
from ledgerlens.sources.tables import read_table
from ledgerlens.streaming import pipeline as SP

Q = entry.queries()


def close(a, b):
    return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-6)


def test_region_profits_sum_to_total(spark):
    total = Q["record_kpis"](spark, SF001).collect()[0][S.TOTAL_PROFIT]
    parts = sum(r[S.TOTAL_PROFIT] for r in Q["profit_by_region"](spark, SF001).collect())
    assert close(parts, total)


def test_monthly_trend_sums_to_overview_total(spark):
    kpi = Q["overview_kpis"](spark, SF001).collect()[0]
    months = Q["monthly_trend"](spark, SF001).collect()
    assert close(sum(r[S.TOTAL_REVENUE] for r in months), kpi[S.TOTAL_REVENUE])
    assert close(sum(r[S.TOTAL_PROFIT] for r in months), kpi[S.TOTAL_PROFIT])


def test_star_keeps_every_line(spark):
    lines = read_table(spark, SF001, "lineitem").count()
    assert Q["row_count"](spark, SF001).collect()[0]["rows"] == lines
    assert sales_fact(spark, SF001).count() == lines  # all five joins, no loss, no fan-out


def test_summary_answers_like_lines_and_orders(spark):
    from ledgerlens.operators import aggregates as A
    from ledgerlens.operators import overview as O
    from ledgerlens.sources.star import order_totals
    from ledgerlens.sources.summary import write_summary

    summary, orders, lines = write_summary(spark, SF001), order_totals(spark, SF001), sales_fact(spark, SF001)
    questions = [
        A.profit_by_region,
        A.top_country_in_top_region,
        A.avg_units_by_month,
        A.yoy_growth_pct,
        A.filter_options,
        A.monthly_trend,
        lambda f: A.top_by_profit(f, S.COUNTRY, 10),
        lambda f: O.overview_of_orders(f, [1996], ["ASIA"], None)["metrics"],
        lambda f: O.overview_of_orders(f, None, ["ASIA", "AFRICA"], ["BUILDING"])["monthly"],
        lambda f: O.overview_of_orders(f, [1990], None, None)["metrics"],
    ]
    for ask in questions:
        want = sorted(map(str, ask(orders).collect()))
        assert sorted(map(str, ask(summary).collect())) == want
    by_item = lambda f: sorted(map(str, A.top_by_profit(f, S.ITEM_TYPE, 10).collect()))
    assert by_item(summary) == by_item(lines)


def test_hourly_revenue_of_page_sums_to_window(spark):
    page = Q["event_page"](spark, SF001).agg(F.sum(S.TOTAL_REVENUE)).collect()[0][0]
    hourly = sum(r[S.TOTAL_REVENUE] for r in Q["hourly_revenue"](spark, SF001).collect())
    assert close(page, hourly)
    assert Q["batch_metrics"](spark, SF001).collect()[0]["events_ingested"] == 120


def test_deep_page_equals_sorted_rows(spark):
    events = sales_fact(spark, SF001, PAGE_COLUMNS).withColumn(
        S.EVENT_TIME, event_time(S.ORDER_DATE, S.ORDER_ID)
    )
    spec = PG.clamp_page(60000, 120, 41234, 10)
    order = PG.event_order(events.columns)
    page = PG.event_page(events, spec).orderBy("pos").collect()
    want = events.orderBy(*order).offset(spec.window_start).limit(1200).collect()
    assert len(page) == 1200
    assert [tuple(r[c] for c in events.columns) for r in page] == [tuple(r) for r in want]


@pytest.fixture(scope="module")
def stream_run(spark):
    run = SP.new_run(spark, "invariants")
    bronze = SP.write_bronze(SP.events_source(spark, SF001), run)
    silver = SP.write_silver(spark, bronze, run)
    quarantine = SP.write_quarantine(spark, bronze, run)
    hourly = SP.write_hourly(spark, silver, run)
    return run, bronze, silver, quarantine, hourly


def test_bronze_is_silver_plus_quarantine(spark, stream_run):
    _, bronze, silver, quarantine, _ = stream_run
    n_bronze = spark.read.schema(SP.BRONZE_SCHEMA).parquet(bronze).count()
    n_silver = SP.read_silver(spark, silver).count()
    n_quar = spark.read.parquet(quarantine).count() if n_bronze != n_silver else 0
    assert n_bronze == n_silver + n_quar == read_table(spark, SF001, "events").count()


def test_streamed_hourly_equals_batch_hourly(spark, stream_run):
    _, _, silver, _, hourly = stream_run
    streamed = SP.read_hourly(spark, hourly)
    batch = SP.hourly_kpis(SP.read_silver(spark, silver))
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    assert streamed.agg(F.sum("events")).collect()[0][0] == 10000


def test_rerun_of_finished_stream_is_idempotent(spark, stream_run):
    run, bronze, silver, _, hourly = stream_run
    before = SP.read_hourly(spark, hourly).collect()
    SP.write_hourly(spark, silver, run)  # same checkpoint: nothing new to process
    after = SP.read_hourly(spark, hourly).collect()
    assert sorted(before) == sorted(after)


def test_quarantine_catches_broken_rows(spark):
    rows = [
        (1, "2024-01-01 00:10:00", 3, "view", 1.0, '{"k": 1}'),
        (2, "2024-01-01 00:20:00", 3, "teleport", 1.0, '{"k": 1}'),
        (3, "2024-01-01 00:30:00", 3, " Click ", -2.0, '{"k": 1}'),
        (4, "2024-01-01 00:40:00", 3, "click", 2.0, "not json"),
        (5, None, 3, "click", 2.0, '{"k": 1}'),
    ]
    df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
    df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    reasons = {r.event_id: r.reason for r in SP.quarantine_rows(df).collect()}
    assert reasons == {
        2: "unknown event_type",
        3: "negative value",
        4: "malformed props",
        5: "missing ts",
    }


def crash_before_commit(run, name):
    """As after a crash between a batch's output and its commit: the last batch runs again."""
    import glob
    import os

    folder = run.checkpoint(name).removeprefix("file:") + "/commits"
    last = max(int(f) for f in os.listdir(folder) if f.isdigit())
    for f in glob.glob(f"{folder}/{last}") + glob.glob(f"{folder}/.{last}.crc"):
        os.remove(f)
    return last


def test_serving_sums_of_a_batch_frame(spark):
    users = spark.createDataFrame(
        [(u, r, s) for u, r in [(1, "ASIA"), (2, "EUROPE")] for s in range(SP.USER_SALTS)],
        "user_id long, region string, salt int",
    )
    batch = spark.createDataFrame(
        [(1, 1, "view", 1.25), (2, 1, "view", 2.0), (3, 2, "click", 0.5), (4, 9, "view", 1.0), (5, None, "view", 1.0)],
        "event_id long, user_id long, event_type string, value double",
    )
    got = {(r.region, r.event_type): (r.events, float(r.total_value)) for r in SP.serving_sums(batch, users).collect()}
    assert got == {("ASIA", "view"): (2, 3.25), ("EUROPE", "click"): (1, 0.5), (None, "view"): (2, 2.0)}


def test_replayed_silver_batch_changes_nothing_downstream(spark):
    """Write, downstream, the silver batch again, downstream again: unchanged totals."""
    run = SP.new_run(spark, "replayed-batch")
    bronze = SP.write_bronze(SP.events_source(spark, SF001), run)
    silver = SP.write_silver(spark, bronze, run)
    hourly = SP.write_hourly(spark, silver, run)
    serving = SP.write_serving(spark, silver, SF001, run)
    before = sorted(SP.read_hourly(spark, hourly).collect()), sorted(SP.read_serving(spark, serving).collect(), key=repr)
    assert crash_before_commit(run, "silver") == 0
    SP.write_silver(spark, bronze, run)
    SP.write_hourly(spark, silver, run)
    SP.write_serving(spark, silver, SF001, run)
    assert SP.read_silver(spark, silver).count() == 10000
    after = sorted(SP.read_hourly(spark, hourly).collect()), sorted(SP.read_serving(spark, serving).collect(), key=repr)
    assert before == after
    assert sum(r.events for r in after[0]) == 10000


def test_streams_killed_between_two_batches(spark):
    """Windows and serving rows after a kill and a restart in the middle equal the batch answer."""
    events = read_table(spark, SF001, "events")
    run = SP.new_run(spark, "killed")
    landing = run.sink("source")
    for part in (events.where("event_id % 3 = 0"), events.where("event_id % 3 <> 0")):
        part.write.mode("append").parquet(landing)
        bronze = SP.write_bronze(SP.events_source(spark, landing, file_glob="*.parquet"), run)
        silver = SP.write_silver(spark, bronze, run)
        hourly = SP.write_hourly(spark, silver, run)
        serving = SP.write_serving(spark, silver, SF001, run)
        for name in ("bronze", "silver", "hourly", "serving"):
            crash_before_commit(run, name)
    # the last batch of every stage runs again
    SP.write_bronze(SP.events_source(spark, landing, file_glob="*.parquet"), run)
    SP.write_silver(spark, bronze, run)
    SP.write_hourly(spark, silver, run)
    SP.write_serving(spark, silver, SF001, run)
    silver_df = SP.read_silver(spark, silver)
    assert silver_df.count() == 10000
    streamed, batch = SP.read_hourly(spark, hourly), SP.hourly_kpis(silver_df)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    users = SP.co_partitioned_users(spark, SF001)
    want = SP.serving_sums(silver_df, users).withColumn("total_value", F.col("total_value").cast("double"))
    got = SP.read_serving(spark, serving)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    users.unpersist()


def test_a_batch_writes_only_the_windows_it_changed(spark):
    events = read_table(spark, SF001, "events")
    run = SP.new_run(spark, "changes")
    landing = run.sink("source")
    edge = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    for part in (events.where(F.col("ts") >= edge), events.where(F.col("ts") < edge)):
        part.write.mode("append").parquet(landing)
        bronze = SP.write_bronze(SP.events_source(spark, landing, file_glob="*.parquet"), run)
        hourly = SP.write_hourly(spark, SP.write_silver(spark, bronze, run), run)
    second = spark.read.parquet(f"{hourly}/batch=1")
    assert 0 < second.count() <= 24
    assert second.where(F.col("window_start") >= edge).count() == 0


def test_repeats_on_another_day_count_once(spark):
    run = SP.new_run(spark, "days")
    landing = run.sink("source")
    events = read_table(spark, SF001, "events").limit(1000).cache()
    for days in (0, 1, 40):
        moved = events.withColumn("ts", F.col("ts") + F.expr(f"INTERVAL {days} DAY"))
        moved.write.mode("append").parquet(landing)
        bronze = SP.write_bronze(SP.events_source(spark, landing, file_glob="*.parquet"), run)
        silver = SP.write_silver(spark, bronze, run)
    kept = SP.read_silver(spark, silver)
    assert kept.count() == kept.select("event_id").distinct().count() == 1000
    assert kept.select("event_id", "ts").exceptAll(events.select("event_id", "ts")).count() == 0
    assert spark.read.schema(SP.BRONZE_SCHEMA).parquet(bronze).count() == 3000


def test_replayed_events_are_deduplicated(spark):
    run = SP.new_run(spark, "replay-test")
    events = SP.events_source(spark, SF001)
    bronze = SP.write_bronze(events.unionByName(SP.events_source(spark, SF001)), run)
    silver = SP.write_silver(spark, bronze, run)
    assert spark.read.schema(SP.BRONZE_SCHEMA).parquet(bronze).count() == 20000
    ids = SP.read_silver(spark, silver).groupBy("event_id").count()
    assert ids.count() == 10000 and ids.where("count > 1").count() == 0


def test_text_ingest_splits_into_silver_and_quarantine(spark):
    run = SP.new_run(spark, "text-test")
    bronze = SP.write_text_bronze(events_as_text(SP.events_source(spark, SF001)), run)
    silver = SP.write_text_silver(spark, bronze, run)
    quarantine = SP.write_text_quarantine(spark, bronze, run)
    n_silver = SP.read_silver(spark, silver).count()
    q = spark.read.schema(SP.QUARANTINE_TEXT_SCHEMA).parquet(quarantine)
    assert n_silver + q.count() == 10000
    reasons = {r.reason for r in q.select("reason").distinct().collect()}
    assert reasons == {"missing value", "malformed props"}
    types = {r.event_type for r in SP.read_silver(spark, silver).select("event_type").distinct().collect()}
    assert "signup" in types and " SIGNUP " not in types


def test_run_pipeline_twice_is_incremental(spark):
    run = SP.new_run(spark, "pipeline-test")
    first = SP.run_pipeline(spark, SF001, paths=run)
    served = sorted(SP.read_serving(spark, first["serving"]).collect())
    second = SP.run_pipeline(spark, SF001, paths=run)  # nothing new: same outputs
    assert first == second
    assert sorted(SP.read_serving(spark, second["serving"]).collect()) == served
    assert SP.read_hourly(spark, second["hourly"]).agg(F.sum("events")).first()[0] == 10000


def test_late_rows_reach_silver_and_windows(spark):
    events = read_table(spark, SF001, "events")
    run = SP.new_run(spark, "late")
    src = run.sink("source")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    # first delivery: two weeks of events; second delivery: the rest plus late
    # copies (new ids) of events from the first days, far behind the others, and repeats
    late = events.where(F.col("ts") < F.lit("2024-01-03 00:00:00").cast("timestamp_ntz")).withColumn(
        "event_id", F.col("event_id") + F.lit(1_000_000)
    )
    n_late = late.count()
    assert n_late > 0

    def run_stages():
        bronze = SP.write_bronze(SP.events_source(spark, src, file_glob="*.parquet"), run)
        silver = SP.write_silver(spark, bronze, run)
        return bronze, silver, SP.write_hourly(spark, silver, run)

    events.where(F.col("ts") < cut).coalesce(1).write.mode("append").parquet(src)
    run_stages()
    again = events.where(F.col("event_id") % 100 == 7)
    events.where(F.col("ts") >= cut).unionByName(late).unionByName(again).coalesce(1).write.mode("append").parquet(src)
    bronze, silver, hourly = run_stages()  # same checkpoints: only the new file

    # bronze keeps every raw record; silver every event once, late ones included
    n_bronze = spark.read.schema(SP.BRONZE_SCHEMA).parquet(bronze).count()
    assert n_bronze == 10000 + n_late + again.count()
    silver_df = SP.read_silver(spark, silver)
    assert silver_df.count() == 10000 + n_late
    assert silver_df.where(F.col("event_id") >= 1_000_000).count() == n_late
    streamed = SP.read_hourly(spark, hourly)
    assert streamed.agg(F.sum("events")).first()[0] == 10000 + n_late
    batch = SP.hourly_kpis(silver_df)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_sales_stream_accounts_for_every_line(spark):
    from ledgerlens.streaming import sales as SL

    run = SP.new_run(spark, "sales-test")
    landing = write_landing(sales_fact(spark, SF001, S.SALES_COLUMNS), run.sink("landing"))
    silver = SL.write_sales_silver(spark, landing, run)
    quarantine = SL.write_sales_quarantine(spark, landing, run)
    hourly = SL.write_sales_hourly(spark, silver, run)
    windows = SL.read_sales_hourly(spark, hourly)
    in_windows = windows.agg(F.sum("lines")).first()[0]
    rejected = spark.read.schema(SL.QUARANTINE_SALES_SCHEMA).parquet(quarantine).count()
    assert in_windows + rejected == 60000
    # revenue: exact decimal total of the parsed lines vs the sum of per-hour doubles
    silver_df = spark.read.schema(SL.SILVER_SALES_SCHEMA).parquet(silver)
    silver_rev = float(silver_df.agg(F.sum(S.TOTAL_REVENUE)).first()[0])
    assert close(silver_rev, windows.agg(F.sum(S.TOTAL_REVENUE)).first()[0])


def test_quarantine_query_returns_every_row_of_the_split(spark, tmp_path):
    from ledgerlens.streaming.catalog import STREAM_ORACLE_SQL, q_stream_quarantine

    rows = [
        (1, "2024-01-01 00:10:00", 3, "view", 1.0, '{"k": 1}'),
        (2, "2024-01-01 00:20:00", 3, "teleport", 1.0, '{"k": 1}'),
        (3, "2024-01-01 00:30:00", 3, " Click ", -2.0, '{"k": 1}'),
        (4, "2024-01-01 00:40:00", None, " Click ", 2.0, '{"k": 4}'),
        (5, None, 3, "click", 2.0, '{"k": 1}'),
        (None, "2024-01-01 00:50:00", 3, "click", 2.0, '{"k": 1}'),
    ]
    df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
    df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(str(tmp_path / "rows"))
    (tmp_path / "events.parquet").write_bytes(next((tmp_path / "rows").glob("*.parquet")).read_bytes())
    got = q_stream_quarantine(spark, str(tmp_path))
    assert {(r.event_id, r.event_type, r.reason) for r in got.collect()} == {
        (1, "view", None),
        (2, "teleport", "unknown event_type"),
        (3, " Click ", "negative value"),
        (4, "click", None),
        (5, "click", "missing ts"),
        (None, "click", "missing event_id"),
    }
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet')")
    want = con.sql(STREAM_ORACLE_SQL["stream_quarantine"]).fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.collect())
