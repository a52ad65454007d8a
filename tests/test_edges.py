"""Edge cases on tiny inline frames (FIXTURES.md section 1.4)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.functions.calendar import event_time, year_ranges
from ledgerlens.functions.money import margin_total_pct, margin_unit_pct
from ledgerlens.operators import aggregates as A
from ledgerlens.operators import overview as O
from ledgerlens.operators import paging as PG
from ledgerlens.operators.filters import optional_filter, strict_filter
from ledgerlens.operators.ranking import slice_rows
from ledgerlens.sources.cleaning import clean_sales_text, strict_date
from ledgerlens.sources.synthetic import empty_sales, synthetic_sales


def sales_rows(spark, rows):
    """Typed sales rows; unspecified columns get harmless defaults."""
    base = {
        S.REGION: "R1",
        S.COUNTRY: "C1",
        S.ITEM_TYPE: "I1",
        S.SALES_CHANNEL: "Online",
        S.ORDER_PRIORITY: "H",
        S.ORDER_DATE: dt.datetime(2012, 6, 4),
        S.ORDER_ID: 1,
        S.SHIP_DATE: dt.datetime(2012, 6, 10),
        S.UNITS_SOLD: Decimal("10.00"),
        S.UNIT_PRICE: 10.0,
        S.UNIT_COST: 6.0,
        S.TOTAL_REVENUE: Decimal("100.0000"),
        S.TOTAL_COST: Decimal("60.0000"),
        S.TOTAL_PROFIT: Decimal("40.0000"),
    }
    data = [tuple({**base, **r}[c] for c in S.SALES_COLUMNS) for r in rows]
    return spark.createDataFrame(data, S.SALES_SCHEMA)


# ---------------------------------------------------------------- bad text


def text_rows(spark, rows):
    cols = S.SALES_COLUMNS
    base = {c: None for c in cols}
    base.update(
        {
            S.REGION: "R1",
            S.ORDER_DATE: "5/8/2012",
            S.ORDER_ID: "7",
            S.UNITS_SOLD: "3",
            S.UNIT_PRICE: "2.50",
            S.TOTAL_REVENUE: "7.50",
        }
    )
    data = [tuple({**base, **r}[c] for c in cols) for r in rows]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols))


def test_lenient_cleaning_drops_bad_dates_and_nulls_bad_numbers(spark):
    raw = text_rows(
        spark,
        [
            {S.ORDER_ID: "1"},
            {S.ORDER_ID: "2", S.ORDER_DATE: "05/08/2012"},
            {S.ORDER_ID: "3", S.ORDER_DATE: "13/45/2010"},
            {S.ORDER_ID: "4", S.ORDER_DATE: ""},
            {S.ORDER_ID: "5", S.ORDER_DATE: None},
            {S.ORDER_ID: "6", S.UNITS_SOLD: "abc", S.UNIT_PRICE: ""},
            {S.ORDER_ID: "x8"},
        ],
    )
    out = {r[S.ORDER_ID]: r for r in clean_sales_text(raw).collect()}
    assert set(out) == {1, 2, 6, None}
    assert out[1][S.ORDER_DATE] == dt.datetime(2012, 5, 8)
    assert out[2][S.ORDER_DATE] == dt.datetime(2012, 5, 8)
    assert out[6][S.UNITS_SOLD] is None and out[6][S.UNIT_PRICE] is None
    assert out[1][S.UNITS_SOLD] == Decimal("3.00")


def test_strict_date_raises_on_malformed(spark):
    df = spark.createDataFrame([("13/45/2010",)], "d string")
    with pytest.raises(PySparkException):
        df.select(strict_date("d")).collect()


# ---------------------------------------------------------------- zero denominators


def test_zero_price_and_revenue_give_null_margins(spark):
    df = sales_rows(
        spark,
        [
            {S.ORDER_ID: 1, S.UNIT_PRICE: 0.0, S.TOTAL_REVENUE: Decimal(0), S.TOTAL_PROFIT: Decimal(-5)},
            {S.ORDER_ID: 2, S.UNIT_PRICE: 10.0, S.UNIT_COST: 7.5},
        ],
    )
    rows = df.select(
        S.ORDER_ID,
        margin_unit_pct(S.UNIT_PRICE, S.UNIT_COST).alias("u"),
        margin_total_pct(S.TOTAL_PROFIT, S.TOTAL_REVENUE).alias("t"),
    ).orderBy(S.ORDER_ID).collect()
    assert rows[0]["u"] is None and rows[0]["t"] is None
    assert rows[1]["u"] == 25.0 and rows[1]["t"] == 40.0
    # nulls are skipped by the mean
    rec = O.record_kpis(df).collect()[0]
    assert rec["avg_margin"] == 25.0 and rec["rows"] == 2


# ---------------------------------------------------------------- ties


def test_top3_ties_at_rank_three_broken_by_row_key(spark):
    rows = [
        {S.ORDER_ID: i, S.TOTAL_PROFIT: Decimal(p)}
        for i, p in [(10, 50), (11, 40), (12, 30), (9, 30), (13, 10)]
    ]
    got = A.top3_orders_per_item(sales_rows(spark, rows)).select(S.ORDER_ID).collect()
    assert sorted(r[0] for r in got) == [9, 10, 11]


def test_equal_region_profit_picks_smallest_name(spark):
    df = sales_rows(
        spark,
        [
            {S.REGION: "Beta", S.TOTAL_PROFIT: Decimal(7)},
            {S.REGION: "Alpha", S.TOTAL_PROFIT: Decimal(7)},
        ],
    )
    assert A.top_profit_region(df).collect()[0][S.REGION] == "Alpha"


def test_top_country_in_top_region_single_dag(spark):
    df = sales_rows(
        spark,
        [
            {S.REGION: "A", S.COUNTRY: "x", S.TOTAL_PROFIT: Decimal(5)},
            {S.REGION: "A", S.COUNTRY: "y", S.TOTAL_PROFIT: Decimal(6)},
            {S.REGION: "B", S.COUNTRY: "z", S.TOTAL_PROFIT: Decimal(10)},
        ],
    )
    row = A.top_country_in_top_region(df).collect()[0]
    assert (row[S.REGION], row[S.COUNTRY], row[S.TOTAL_PROFIT], row["region_profit"]) == (
        "A", "y", 6.0, 11.0
    )


# ---------------------------------------------------------------- calendar


def test_weekend_filter_friday_to_monday(spark):
    days = [dt.datetime(2024, 1, d) for d in (5, 6, 7, 8)]  # Fri Sat Sun Mon
    df = sales_rows(
        spark,
        [{S.ORDER_ID: i, S.ORDER_DATE: d, S.REGION: "R", S.UNITS_SOLD: Decimal(i + 1)} for i, d in enumerate(days)],
    )
    got = A.weekend_units_by_item(df, "R").collect()
    assert [(r[S.ITEM_TYPE], r["sum_units_sold"]) for r in got] == [("I1", 5.0)]


def test_72h_windows_are_epoch_aligned(spark):
    # 72-h buckets from 1970-01-01: 2023-12-31 is day 19722 = 3 * 6574, a bucket start
    starts = A.orders_per_window(
        sales_rows(
            spark,
            [
                {S.ORDER_ID: 1, S.ORDER_DATE: dt.datetime(2023, 12, 30, 23, 59)},
                {S.ORDER_ID: 2, S.ORDER_DATE: dt.datetime(2023, 12, 31)},
                {S.ORDER_ID: 3, S.ORDER_DATE: dt.datetime(2024, 1, 2, 23, 59)},
                {S.ORDER_ID: 4, S.ORDER_DATE: dt.datetime(2024, 1, 3)},
            ],
        )
    ).orderBy("window_start").collect()
    epoch = dt.datetime(1970, 1, 1)
    for r in starts:
        assert (r["window_start"] - epoch).total_seconds() % (72 * 3600) == 0
    assert [r["count_order_id"] for r in starts] == [1, 2, 1]
    assert starts[1]["window_start"] == dt.datetime(2023, 12, 31)


def test_year_boundary_and_year_ranges(spark):
    df = sales_rows(
        spark,
        [
            {S.ORDER_ID: 1, S.ORDER_DATE: dt.datetime(2011, 12, 31, 23, 0)},
            {S.ORDER_ID: 2, S.ORDER_DATE: dt.datetime(2012, 1, 1)},
        ],
    )
    assert optional_filter(df, years=[2012]).select(S.ORDER_ID).collect()[0][0] == 2
    assert year_ranges([2014, 2012, 2013, 2016]) == [(2012, 2015), (2016, 2017)]


def test_yoy_first_year_null_and_small_change_label(spark):
    df = sales_rows(
        spark,
        [
            {S.ORDER_ID: 1, S.ORDER_DATE: dt.datetime(2010, 3, 1), S.TOTAL_REVENUE: Decimal(1000)},
            {S.ORDER_ID: 2, S.ORDER_DATE: dt.datetime(2011, 3, 1), S.TOTAL_REVENUE: Decimal("995.6")},
            {S.ORDER_ID: 3, S.ORDER_DATE: dt.datetime(2012, 3, 1), S.TOTAL_REVENUE: Decimal(2000)},
        ],
    )
    labels = [r["yoy_growth"] for r in A.yoy_growth_label(df).collect()]
    assert labels == [None, "0 %", "101 %"]


# ---------------------------------------------------------------- nulls


def test_null_order_id_event_time_offset_zero_and_null_region_not_an_option(spark):
    df = sales_rows(
        spark,
        [
            {S.ORDER_ID: None, S.REGION: None, S.ORDER_DATE: dt.datetime(2020, 1, 1)},
            {S.ORDER_ID: 25, S.ORDER_DATE: dt.datetime(2020, 1, 1)},
        ],
    )
    et = df.select(S.ORDER_ID, event_time(S.ORDER_DATE, S.ORDER_ID).alias("e")).collect()
    got = {r[S.ORDER_ID]: r["e"] for r in et}
    assert got[None] == dt.datetime(2020, 1, 1)
    assert got[25] == dt.datetime(2020, 1, 1, 1, 25)
    options = A.filter_options(df).collect()
    assert ("region", "R1") in {(r.kind, r.value) for r in options}
    assert all(r.value is not None for r in options)
    # count(order_id) skips the null id; count(*) does not
    assert A.orders_per_window(df).collect()[0]["count_order_id"] == 1


# ---------------------------------------------------------------- paging


def test_clamp_rules():
    assert PG.clamp_page(100) == PG.PageSpec(100, 30, 100, 4)
    assert PG.clamp_page(3, batch_size=1) == PG.PageSpec(3, 5, 5, 4)  # total < batch
    assert PG.clamp_page(1000, stream_cursor=2).cursor == 30  # cursor < batch
    assert PG.clamp_page(1000, stream_cursor=5000).cursor == 1000  # cursor > total
    spec = PG.clamp_page(1000, batch_size=500, stream_cursor=200, lookback_batches=99)
    assert (spec.batch, spec.lookback, spec.window_start) == (120, 10, 0)  # lookback > cursor


def test_slice_numbers_every_position_once(spark):
    df = spark.range(0, 5000).select((F.col("id") % 97).alias("t"), F.col("id").alias(S.ORDER_ID))
    order = ["t", S.ORDER_ID]
    want = sorted((i % 97, i) for i in range(5000))[1200:1330]
    for frame in (df, df.repartition(7)):
        rows = slice_rows(frame, order, 1200, 1330).orderBy("pos").collect()
        assert [(r["t"], r[S.ORDER_ID]) for r in rows] == want
        assert [r["pos"] for r in rows] == list(range(1200, 1330))


def test_slice_with_tied_and_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 1), (2, 1), (2, 1), (3, 1)], "t int, id long")
    rows = slice_rows(df, ["t", "id"], 1, 5).orderBy("pos").collect()
    assert [(r["t"], r["pos"]) for r in rows] == [(None, 1), (2, 2), (2, 3), (2, 4)]
    assert slice_rows(df, ["t", "id"], 3, 3).count() == 0
    assert slice_rows(df, ["t", "id"], 6, 9).count() == 0


def test_slice_by_blocks_of_a_crowded_value(spark):
    """One leading value holds most rows: its blocks are counted and ranked apart."""
    rows = [(1, i) for i in range(900)] + [(0, i) for i in range(20)] + [(None, 5), (2, None), (2, 7)]
    df = spark.createDataFrame(rows, "t int, id long").withColumn("b", F.shiftright("id", 6)).repartition(5)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0))
    for start, stop in ((0, 30), (500, 620), (915, 2000), (7, 7)):
        got = slice_rows(df, ["t", "id"], start, stop, block="b").orderBy("pos").collect()
        assert [(r["t"], r["id"]) for r in got] == want[start:stop]
        assert [r["pos"] for r in got] == list(range(start, min(stop, len(want))))


def test_slice_needs_keys_after_the_leading_column(spark):
    with pytest.raises(ValueError):
        slice_rows(spark.range(3), ["id"], 0, 2)


def test_position_index_is_extended_by_new_orders_only(spark, tmp_path):
    from conftest import SF0001
    from ledgerlens.plans import catalog
    from ledgerlens.sources.star import line_counts

    counts = line_counts(spark, SF0001)
    path = str(tmp_path / "index")
    older = counts.where(F.col(S.ORDER_ID) % 3 == 0)
    PG.extend_index(older, path)
    first = PG.read_index(spark, path).agg(F.sum("n")).first()[0]
    PG.extend_index(counts.where(F.col(S.ORDER_ID) % 3 != 0), path)
    kept = PG.read_index(spark, path)
    whole = PG.position_index(counts)
    assert 0 < first < kept.agg(F.sum("n")).first()[0] == 6000
    assert kept.exceptAll(whole).count() == 0 and whole.exceptAll(kept).count() == 0
    sections, _ = catalog._page(spark, SF0001, index=path)
    again, _ = catalog._page(spark, SF0001)
    assert sorted(map(str, sections["page"].collect())) == sorted(map(str, again["page"].collect()))


def test_first_days_of_a_count(spark):
    from ledgerlens.operators.ranking import first_days

    days = [(dt.datetime(2020, 1, d), n) for d, n in [(1, 5), (2, 1), (3, 4)]] + [(None, 9)]
    per_day = spark.createDataFrame(days, "day timestamp_ntz, n long")
    assert first_days(per_day, "day", 6) == dt.datetime(2020, 1, 2)
    assert first_days(per_day, "day", 4, newest=True) == dt.datetime(2020, 1, 3)
    assert first_days(per_day, "day", 5, newest=True) == dt.datetime(2020, 1, 2)
    assert first_days(per_day, "day", 11) is None


def test_previews_of_orders_without_lines(spark, tmp_path):
    """Orders of the last days have no line: more days are taken, the rows stay the same."""
    import shutil

    import __spark_entry__ as entry
    from conftest import SF0001

    folder = copied(SF0001, str(tmp_path / "tables"))
    lines = str(tmp_path / "some")
    orders = spark.read.parquet(f"{SF0001}/orders.parquet").where("year(o_orderdate) < 1997 or o_orderkey % 40 = 0")
    kept = spark.read.parquet(f"{SF0001}/lineitem.parquet").join(
        orders.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi"
    )
    kept.write.parquet(lines)
    shutil.rmtree(f"{folder}/lineitem.parquet")
    shutil.copytree(lines, f"{folder}/lineitem.parquet")
    from ledgerlens.plans import params as P
    from ledgerlens.sources.star import sales_fact

    sales = sales_fact(spark, folder)
    picked = optional_filter(sales, P.SELECTION["years"], P.SELECTION["regions"], None)
    want = O.preview_latest(picked, 200).collect()
    assert entry.queries()["preview_latest"](spark, folder).collect() == want
    assert entry.queries()["preview_first"](spark, folder).collect() == O.preview_first(sales, 100).collect()


def test_money_in_whole_hundredths(spark):
    from ledgerlens.functions.money import exact, hundredths
    from pyspark.sql import types as T

    values = [0.0, 0.01, -0.01, 1.005, 12.345, -12.5, 99999999.99, 0.1 + 0.2, None, 33.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select(hundredths("v").alias("h"), exact(hundredths("v"), 2, T.DecimalType(12, 2)).alias("d")).collect()
    want = [0, 1, -1, 100, 1235, -1250, 9999999999, 30, None, 3300]
    assert [r["h"] for r in rows] == want
    assert [r["d"] for r in rows] == [None if w is None else Decimal(w).scaleb(-2) for w in want]


def test_bitmaps_count_like_distinct(spark):
    from ledgerlens.operators.distinct import count_ids, id_bitmaps

    rows = [("a", 1), ("a", 1), ("b", 1), ("b", 40_000), ("a", None), (None, 7), ("c", -3), ("c", 10**12)]
    df = spark.createDataFrame(rows, "k string, id long")
    bitmaps = id_bitmaps(df, ["k"], "id")
    assert {r["k"]: r["n"] for r in count_ids(bitmaps, ["k"], "n").collect()} == {"a": 1, "b": 2, None: 1, "c": 2}
    assert count_ids(bitmaps, [], "n").first()["n"] == 5
    assert count_ids(id_bitmaps(df.limit(0), ["k"], "id"), [], "n").first()["n"] == 0


def test_source_choice_says_what_it_chose(spark, tmp_path):
    from ledgerlens.sources.csv import write_sales_csv
    from ledgerlens.sources.synthetic import sales_or_demo

    source, rows = sales_or_demo(spark, str(tmp_path / "none.csv"))
    assert source == "demo" and rows.count() == 360
    path = write_sales_csv(sales_rows(spark, [{S.ORDER_ID: 5}]), str(tmp_path / "sales.csv"))
    source, rows = sales_or_demo(spark, path)
    assert source == "csv" and [r[S.ORDER_ID] for r in rows.collect()] == [5]


def test_csv_rejects_name_column_and_reason(spark, tmp_path):
    from ledgerlens.sources.csv import csv_rejects, read_sales_csv

    header = ",".join(S.CSV_HEADER)
    good = "Asia,India,Snacks,Online,H,5/8/2012,1,5/9/2012,3,2.50,1,7.50,3,4.50"
    lines = [
        good,
        good.replace("5/8/2012,1", "13/45/2010,2"),
        good.replace("5/8/2012,1", ",3"),
        good.replace(",1,5/9/2012,3,2.50", ",4,never,abc,"),
        good.replace("5/8/2012,1", "5/8/2012,5") + ",surplus",
        "Asia,India,Snacks,Online,H,5/8/2012,6",
        good.replace("5/8/2012,1", "5/8/2012,x7"),
    ]
    path = tmp_path / "sales.csv"
    path.write_text("\n".join([header, *lines]) + "\n")
    got = {(r.order_id, r.column_name, r.value, r.reason) for r in csv_rejects(spark, str(path)).collect()}
    assert got == {
        ("2", "order_date", "13/45/2010", "unparsable date"),
        ("3", "order_date", None, "missing order date"),
        ("4", "ship_date", "never", "unparsable date"),
        ("4", "units_sold", "abc", "not a number"),
        ("5", None, lines[4], "wrong number of fields"),
        ("6", None, lines[5], "wrong number of fields"),
        ("x7", "order_id", "x7", "not a number"),
    }
    assert read_sales_csv(spark, str(path)).count() == 5


def test_page_status_of_an_empty_table(spark):
    events = empty_sales(spark).withColumn(S.EVENT_TIME, event_time(S.ORDER_DATE, S.ORDER_ID))
    _, sections = PG.page_sections(events, 0)
    assert tuple(sections["status"].first()) == (True, 0, 30, 30, 4)


def test_page_metrics_on_small_table(spark):
    rows = [
        {S.ORDER_ID: i, S.ORDER_DATE: dt.datetime(2020, 1, 1 + i), S.TOTAL_REVENUE: Decimal(i)}
        for i in range(10)
    ]
    events = sales_rows(spark, rows).withColumn(S.EVENT_TIME, event_time(S.ORDER_DATE, S.ORDER_ID))
    spec = PG.clamp_page(10, batch_size=5, stream_cursor=7, lookback_batches=1)
    page = PG.event_page(events, spec)
    assert sorted(r[S.ORDER_ID] for r in page.collect()) == [2, 3, 4, 5, 6]
    m = PG.batch_metrics(page, spec).collect()[0]
    assert (m["events_ingested"], m["batch_revenue"]) == (5, 20.0)


# ---------------------------------------------------------------- selections


def test_selections_none_empty_and_missing_value(spark):
    df = sales_rows(
        spark,
        [{S.ORDER_ID: 1, S.SALES_CHANNEL: "Online"}, {S.ORDER_ID: 2, S.SALES_CHANNEL: "Offline"}],
    )
    assert optional_filter(df).count() == 2
    assert optional_filter(df, channels=[]).count() == 2
    assert optional_filter(df, channels=["Nope"]).count() == 0
    assert strict_filter(df).count() == 2
    assert strict_filter(df, channels=[]).count() == 0
    assert strict_filter(df, channels=["Online"]).count() == 1


def test_empty_overview_flags_empty(spark):
    df = sales_rows(spark, [{S.ORDER_ID: 1}])
    sections = O.overview(df, years=[1990])
    m = sections["metrics"].collect()[0]
    assert m["empty"] is True and m["order_count"] == 0 and m[S.TOTAL_REVENUE] is None
    assert sections["preview"].count() == 0
    assert O.kpis(empty_sales(spark)).collect()[0]["empty"] is True


# ---------------------------------------------------------------- synthetic source


def test_synthetic_demo_rows(spark):
    rows = synthetic_sales(spark).orderBy(S.ORDER_ID).collect()
    assert len(rows) == 360
    r7 = rows[7]
    assert (r7[S.REGION], r7[S.COUNTRY], r7[S.ITEM_TYPE], r7[S.SALES_CHANNEL], r7[S.ORDER_PRIORITY]) == (
        "Europe", "Germany", "Household", "Offline", "C"
    )
    assert r7[S.ORDER_DATE] == dt.datetime(2022, 1, 8)
    assert r7[S.SHIP_DATE] == dt.datetime(2022, 1, 9)
    assert r7[S.UNITS_SOLD] == Decimal("67.00")
    assert r7[S.UNIT_PRICE] == 41.0 and r7[S.UNIT_COST] == 25.42
    assert r7[S.TOTAL_REVENUE] == Decimal("2747.0000")
    assert r7[S.TOTAL_PROFIT] == r7[S.TOTAL_REVENUE] - r7[S.TOTAL_COST]


def test_synthetic_dates_do_not_wrap(spark):
    assert synthetic_sales(spark, 1000).select(S.ORDER_DATE).distinct().count() == 1000


def test_names_are_trimmed(spark):
    rows = clean_sales_text(text_rows(spark, [{S.COUNTRY: "Mali "}, {S.COUNTRY: "Mali"}]))
    assert {r[S.COUNTRY] for r in rows.collect()} == {"Mali"}


def test_window_counts_ids_and_rows(spark):
    df = sales_rows(spark, [{S.ORDER_ID: 1}, {S.ORDER_ID: None}])
    row = A.orders_per_window(df, rows_alias="order_rows").first()
    assert (row["count_order_id"], row["order_rows"]) == (1, 2)


# ---------------------------------------------------------------- sizing and sinks


def test_cluster_conf_sizes_partitions():
    from ledgerlens.session import cluster_conf

    conf = cluster_conf(30 * 1024**4, 8000)
    assert conf["spark.sql.shuffle.partitions"] == str(30 * 1024**4 // (256 * 1024**2))
    assert cluster_conf(10, 16)["spark.sql.shuffle.partitions"] == "32"


def test_write_table_partitioned(spark, tmp_path):
    from ledgerlens.sources.sinks import write_table

    df = synthetic_sales(spark, 20)
    out = write_table(A.yearly_revenue(df), str(tmp_path / "yearly"), partition_by=["year"])
    back = spark.read.parquet(out)
    assert back.count() == 1 and back.columns[-1] == "year"


def copied(sf_dir, to):
    import os
    import shutil

    os.makedirs(to)
    for table in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        shutil.copytree(f"{sf_dir}/{table}.parquet", f"{to}/{table}.parquet") if os.path.isdir(
            f"{sf_dir}/{table}.parquet"
        ) else (os.makedirs(f"{to}/{table}.parquet"), shutil.copy(f"{sf_dir}/{table}.parquet", f"{to}/{table}.parquet/a.parquet"))
    return to


def test_answers_agree_with_dangling_keys_and_see_new_files(spark, tmp_path):
    import shutil

    import __spark_entry__ as entry
    from conftest import SF0001

    q = entry.queries()

    def rows(folder):
        return (
            q["row_count"](spark, folder).first()["rows"],
            q["record_kpis"](spark, folder).first()["rows"],
            q["sales_fact"](spark, folder).count(),
            q["page_status"](spark, folder).first()["total_rows"],
        )

    folder = copied(SF0001, str(tmp_path / "tables"))
    assert rows(folder) == (6000,) * 4
    shutil.copy(f"{folder}/lineitem.parquet/a.parquet", f"{folder}/lineitem.parquet/b.parquet")
    spark.catalog.refreshByPath(folder)
    assert rows(folder) == (12000,) * 4
    half = str(tmp_path / "half")
    spark.read.parquet(f"{SF0001}/part.parquet").where("p_partkey % 2 = 0").write.parquet(half)
    shutil.rmtree(f"{folder}/part.parquet")
    shutil.copytree(half, f"{folder}/part.parquet")
    spark.catalog.refreshByPath(folder)
    counts = rows(folder)
    assert len(set(counts)) == 1 and 0 < counts[0] < 12000


def test_cluster_conf_is_accepted(spark):
    from conftest import SF0001
    from ledgerlens.session import cluster_conf
    from ledgerlens.streaming import pipeline as SP

    conf = cluster_conf(10 * 1024**3, 8)
    runtime = {k: v for k, v in conf.items() if k.startswith("spark.sql.")}
    before = {k: spark.conf.get(k, None) for k in runtime}
    try:
        for k, v in runtime.items():
            spark.conf.set(k, v)
        run = SP.new_run(spark, "rocksdb")
        silver = SP.write_silver(spark, SP.write_bronze(SP.events_source(spark, SF0001), run), run)
        assert SP.read_silver(spark, silver).count() == 1000
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
