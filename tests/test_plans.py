"""Physical-plan properties the design relies on."""

import re

import pytest

import __spark_entry__ as entry
from conftest import SF001

Q = {k: q for k, q in entry.queries().items() if k not in entry.LLM_QUERIES}


def formatted(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_top_k_per_group_uses_window_group_limit(spark):
    text = formatted(Q["top3_orders_per_item"](spark, SF001))
    assert "WindowGroupLimit" in text


def test_page_reaches_the_scan_as_days_and_broadcasts_only_covered_times(spark):
    text = formatted(Q["event_page_deep"](spark, SF001))
    orders = [b for b in text.split("\n\n") if "orders.parquet" in b and "Scan parquet" in b]
    assert "GreaterThanOrEqual(o_orderdate" in orders[0] and "LessThanOrEqual(o_orderdate" in orders[0]


def test_global_top_k_is_take_ordered(spark):
    for name in ("preview_latest", "top_countries_by_profit", "serving_table"):
        assert "TakeOrderedAndProject" in formatted(Q[name](spark, SF001)), name


def test_year_selection_reaches_the_orders_scan(spark):
    text = formatted(Q["filtered_orders"](spark, SF001))
    orders_scan = [b for b in text.split("\n\n") if "orders.parquet" in b and "Scan parquet" in b]
    assert orders_scan
    assert "GreaterThanOrEqual(o_orderdate" in orders_scan[0]
    assert "LessThan(o_orderdate" in orders_scan[0]


def test_column_pruning_on_lineitem(spark):
    text = formatted(Q["profit_by_region"](spark, SF001))
    scan = [b for b in text.split("\n\n") if "lineitem.parquet" in b][0]
    assert "l_shipdate" not in scan and "l_tax" not in scan and "l_returnflag" not in scan


@pytest.mark.parametrize(
    "name",
    ["profit_by_region", "top_country_in_top_region", "monthly_trend", "overview_kpis", "yoy_growth_pct",
     "filter_options", "avg_units_by_month", "top_countries_by_profit"],
)
def test_lines_are_reduced_per_order_before_the_order_join(spark, name):
    text = formatted(Q[name](spark, SF001))
    assert re.search(r"Keys \[1\]: \[(l_orderkey|order_id)#", text), name


@pytest.mark.parametrize("name", ["top_items_by_profit", "weekend_units_by_item"])
def test_lines_are_reduced_per_order_and_item_before_the_order_join(spark, name):
    text = formatted(Q[name](spark, SF001))
    assert re.search(r"Keys \[2\]: \[(l_orderkey|order_id)#", text), name


def test_geo_dimension_is_broadcast(spark):
    text = formatted(Q["profit_by_region"](spark, SF001))
    assert "BroadcastExchange" in text


def scans(text: str, table: str) -> list[str]:
    return [b for b in text.split("\n\n") if "Scan parquet" in b and "Location:" in b and f"{table}.parquet" in b]


def test_summary_answers_scan_no_lines(spark):
    for name in ("sales_cube", "summary_monthly_trend", "summary_kpis"):
        text = formatted(Q[name](spark, SF001))
        assert "sales_summary" in text and not scans(text, "lineitem") and not scans(text, "orders"), name


def test_order_counts_shuffle_bitmaps_not_ids(spark):
    text = formatted(Q["order_count_by_month_and_total"](spark, SF001))
    assert "bitmap_or_agg" in text and not scans(text, "lineitem") and "order_id#" not in text


def test_existence_is_a_semi_join(spark):
    for name in ("row_count", "margin_by_item", "margin_extremes", "order_margin_pct", "record_kpis"):
        text = formatted(Q[name](spark, SF001))
        assert "LeftSemi" in text, name
        orders = scans(text, "orders")
        assert len(orders) == 1 and "o_orderpriority" not in orders[0] and "o_orderdate" not in orders[0], name


def test_top_three_meet_their_orders_after_the_ranking(spark):
    """The order columns are joined above the group limit; below it orders count by key only."""
    text = formatted(Q["top3_orders_per_item"](spark, SF001))
    tree = text.split("\n\n")[0]
    limit = tree.index("WindowGroupLimit")
    wide = [b for b in scans(text, "orders") if "o_orderpriority" in b]
    narrow = [b for b in scans(text, "orders") if "o_orderpriority" not in b]
    assert len(wide) == 1 and len(narrow) == 1
    number = re.match(r"\((\d+)\)", wide[0].strip()).group(1)
    narrow_number = re.match(r"\((\d+)\)", narrow[0].strip()).group(1)
    assert tree.index(f"({narrow_number})") > limit
    depth = lambda n: next(len(line) - len(line.lstrip(" :|+-")) for line in tree.splitlines() if f"({n})" in line)
    limit_depth = next(len(line) - len(line.lstrip(" :|+-")) for line in tree.splitlines() if "WindowGroupLimit" in line)
    assert depth(number) < depth(narrow_number) and limit_depth < depth(narrow_number)


def test_preview_cut_reaches_the_orders_scan(spark):
    latest = scans(formatted(Q["preview_latest"](spark, SF001)), "orders")
    assert len(latest) == 1 and latest[0].count("GreaterThanOrEqual(o_orderdate") >= 2
    first = scans(formatted(Q["preview_first"](spark, SF001)), "orders")
    assert len(first) == 1 and "LessThanOrEqual(o_orderdate" in first[0]


def test_page_reads_the_index_and_its_days(spark):
    text = formatted(Q["event_page"](spark, SF001))
    # the entries that the page covers are in the plan; the index itself is not read again
    assert "position-index" not in text and "Scan ExistingRDD" in text and len(scans(text, "lineitem")) == 1
    assert "GreaterThanOrEqual(o_orderdate" in scans(text, "orders")[0]
    status = formatted(Q["page_status"](spark, SF001))
    assert not scans(status, "lineitem") and not scans(status, "orders")


def test_no_python_udfs_in_batch_plans(spark):
    for name, build in Q.items():
        if name.startswith("stream_"):
            continue
        text = formatted(build(spark, SF001))
        assert "EvalPython" not in text and "PythonUDF" not in text, name


def test_single_fact_pass_for_top_country(spark):
    text = formatted(Q["top_country_in_top_region"](spark, SF001))
    scans = [b for b in text.split("\n\n") if "Scan parquet" in b and "Location:" in b]
    assert sum("lineitem.parquet" in b for b in scans) == 1
    assert "LeftSemi" not in text


def test_serving_join_reuses_the_cached_dimension_layout(spark):
    from conftest import SF0001
    from ledgerlens.sources.tables import read_table
    from ledgerlens.streaming import pipeline as SP

    confs = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in confs}
    users = SP.co_partitioned_users(spark, SF0001)
    try:
        for k in confs:  # as at scale: the dimension is too big to broadcast
            spark.conf.set(k, "-1")
        text = formatted(SP.serving_sums(read_table(spark, SF0001, "events"), users))
    finally:
        users.unpersist()
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "SortMergeJoin" in text and "InMemoryTableScan" in text
    # the only shuffle for the join is that of the events, dealt out by user and salt
    assert len(re.findall(r"hashpartitioning\(user_id#\d+L?, salt#\d+, \d+\), ENSURE_REQUIREMENTS", text)) == 1


def test_top_three_move_no_line_by_its_order(spark):
    """All lines are ranked without their orders: the plan meets only the few that come first."""
    text = formatted(Q["top3_orders_per_item"](spark, SF001))
    assert "top-lines" in text and not scans(text, "lineitem")


@pytest.mark.parametrize("dangling", [10, 40])
def test_top_three_without_the_orders_of_the_best_lines(spark, tmp_path, dangling):
    """Few or most of the candidates have no order."""
    import shutil

    from conftest import SF0001
    from oracle_util import compare, duck

    con = duck(SF0001)
    for t in ("region", "nation", "customer", "part", "lineitem"):
        shutil.copy(f"{SF0001}/{t}.parquet", tmp_path)
    con.sql(f"""COPY (SELECT * FROM orders WHERE o_orderkey NOT IN (
      SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey
      QUALIFY row_number() OVER (PARTITION BY p_type
        ORDER BY l_extendedprice * (1 - l_discount) - l_quantity * p_retailprice DESC) <= {dangling}))
      TO '{tmp_path}/orders.parquet' (FORMAT parquet)""")
    con.sql(f"CREATE OR REPLACE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet'")
    got = Q["top3_orders_per_item"](spark, str(tmp_path)).toPandas()
    assert len(got) > 0 and compare(got, con.sql(entry.oracle_sql()["top3_orders_per_item"]).df()) == []
