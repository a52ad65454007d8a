"""Query catalogue: name -> Spark plan builder ``(spark, sf_dir) -> DataFrame``.

Each builder reads the driver tables through the star view with only the
columns it needs, applies ledgerlens operators and returns a lazy DataFrame.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.fixtures import orders_as_text, write_defective_landing
from ledgerlens.functions.calendar import month_label
from ledgerlens.functions.formatting import count_text, money_text, percent_text
from ledgerlens.operators import aggregates as A
from ledgerlens.operators import overview as O
from ledgerlens.operators import paging as PG
from ledgerlens.operators.distinct import count_ids, id_bitmaps
from ledgerlens.operators.filters import optional_filter, strict_filter
from ledgerlens.operators.joins import best_group, checked_broadcast, restrict_to
from ledgerlens.operators.ranking import first_days, top_n
from ledgerlens.plans import params as P
from ledgerlens.session import scratch_path
from ledgerlens.sources import cleaning as C
from ledgerlens.sources.csv import csv_rejects, read_sales_csv, write_sales_csv
from ledgerlens.sources.materialize import materialize_fact
from ledgerlens.sources.sinks import write_table
from ledgerlens.sources.star import (
    line_counts,
    of_valid_orders,
    order_dimension,
    order_item_totals,
    order_table,
    order_totals,
    priced_lines,
    sales_fact,
    with_order_columns,
)
from ledgerlens.sources.summary import sales_cube, write_summary
from ledgerlens.sources.synthetic import sales_or_demo, synthetic_sales_from_index
from ledgerlens.sources.tables import read_table

Builder = Callable[[SparkSession, str], DataFrame]


def _fact(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return sales_fact(spark, sf_dir, list(cols) if cols else None)


def q_sales_fact(spark, sf_dir):
    return O.as_output(_fact(spark, sf_dir))


def q_row_count(spark, sf_dir):
    return A.row_count(_fact(spark, sf_dir, S.ORDER_ID))


def q_profit_by_region(spark, sf_dir):
    return A.profit_by_region(order_totals(spark, sf_dir))


def q_top_profit_region(spark, sf_dir):
    return A.top_profit_region(order_totals(spark, sf_dir))


def q_top_country_in_top_region(spark, sf_dir):
    return A.top_country_in_top_region(order_totals(spark, sf_dir))


def q_top_region_lines(spark, sf_dir):
    """All lines of the most profitable region (the best region fed back as a
    broadcast semi-join instead of a value passed through the driver)."""
    sales = _fact(spark, sf_dir)
    best = A.top_profit_region(order_totals(spark, sf_dir))  # one row: a top-1
    return O.as_output(restrict_to(sales, best, [S.REGION], known_rows=1))


def q_top_region_lines_of_copy(spark, sf_dir):
    """The same lines from a copy of the fact partitioned by region: the copy is the
    one pass over the lines, and the chosen region prunes its folders at run time."""
    copy = materialize_fact(spark, sf_dir, partition_by=S.REGION)
    best = best_group(A.profit_by(copy, [S.REGION]), [F.desc(S.TOTAL_PROFIT), F.asc(S.REGION)], [S.REGION])
    lines = copy.join(F.broadcast(best), S.REGION).select(*S.FACT_COLUMNS)  # one row: the best group
    return O.as_output(lines)


def q_orders_per_72h(spark, sf_dir):
    return A.orders_per_window(order_table(spark, sf_dir), duration="72 hours")


def q_max_orders_72h(spark, sf_dir):
    return A.max_orders_per_window(order_table(spark, sf_dir), duration="72 hours")


def q_sliding_72h(spark, sf_dir):
    return A.orders_per_window(order_table(spark, sf_dir), duration="72 hours", slide="1 day")


def q_avg_units_by_month(spark, sf_dir):
    return A.avg_units_by_month(order_totals(spark, sf_dir))


def q_best_month_by_units(spark, sf_dir):
    by_month = A.avg_units_by_month(order_totals(spark, sf_dir))
    return top_n(by_month, 1, [F.desc("avg_units_sold"), F.asc(S.MONTH)])


def q_order_margin_pct(spark, sf_dir):
    return A.order_margin_pct(_fact(spark, sf_dir, S.ORDER_ID, S.UNIT_PRICE, S.UNIT_COST))


def q_margin_extremes(spark, sf_dir):
    return A.margin_extremes(_fact(spark, sf_dir, S.ORDER_ID, S.UNIT_PRICE, S.UNIT_COST))


#: Lines of an item type that are ranked before it is known whether their order exists.
CANDIDATES = 24


def q_top3_orders_per_item(spark, sf_dir):
    """Lines are ranked before they meet their order; a few of an item type look theirs up.

    The first ``CANDIDATES`` of every item type hold its first three of valid
    orders, unless more of them dangle; then all lines meet their orders first.
    """
    columns = [c for c in S.FACT_COLUMNS if c not in S.ORDER_COLUMNS]
    types = read_table(spark, sf_dir, "part").select("p_type").distinct().count()
    lines = priced_lines(spark, sf_dir, late=True).select(*columns)
    path = write_table(
        A.top3_orders_per_item(A.of_high_profit(lines, CANDIDATES, types), CANDIDATES),
        scratch_path(spark, "top-lines"),
    )
    first = spark.read.schema(lines.schema).parquet(path)
    keys = checked_broadcast(first.select(S.ORDER_ID), CANDIDATES * types)
    valid = of_valid_orders(first, spark, sf_dir, among=keys)
    counts = first.select(S.ITEM_TYPE, F.lit(0).alias("valid")).union(valid.select(S.ITEM_TYPE, F.lit(1)))
    per_type = counts.groupBy(S.ITEM_TYPE).agg(
        F.count_if(F.col("valid") == 0).alias("n"), F.sum("valid").alias("valid")
    )
    if not per_type.where((F.col("n") >= CANDIDATES) & (F.col("valid") < 3)).isEmpty():
        valid = of_valid_orders(lines, spark, sf_dir)
    best = A.top3_orders_per_item(valid)
    return O.as_output(with_order_columns(checked_broadcast(best, 3 * types), spark, sf_dir, S.FACT_COLUMNS))


def q_weekend_units_by_item(spark, sf_dir):
    return A.weekend_units_by_item(order_item_totals(spark, sf_dir), P.WEEKEND_REGION)


def q_weekend_top5(spark, sf_dir):
    return q_weekend_units_by_item(spark, sf_dir).limit(5)


def q_yoy_growth_label(spark, sf_dir):
    return A.yoy_growth_label(order_totals(spark, sf_dir))


def q_yoy_growth_pct(spark, sf_dir):
    return A.yoy_growth_pct(order_totals(spark, sf_dir))


def q_filter_options(spark, sf_dir):
    return A.filter_options(order_totals(spark, sf_dir))


def _optional(spark, sf_dir, sel):
    return optional_filter(_fact(spark, sf_dir), sel["years"], sel["regions"], sel["channels"])


def _strict(spark, sf_dir, sel):
    return strict_filter(_fact(spark, sf_dir), sel["years"], sel["regions"], sel["channels"])


def q_filtered_orders(spark, sf_dir):
    return O.as_output(_optional(spark, sf_dir, P.SELECTION))


def q_filtered_orders_strict(spark, sf_dir):
    return O.as_output(_strict(spark, sf_dir, P.STRICT_SELECTION))


def q_filtered_orders_strict_empty(spark, sf_dir):
    """Rows of the strict selection with each of its lists empty in turn, and with none empty."""
    counts = []
    for empty in ("years", "regions", "channels", "none"):
        sel = {k: [] if k == empty else v for k, v in P.STRICT_SELECTION.items()}
        rows = A.row_count(_strict(spark, sf_dir, sel))
        counts.append(rows.select(F.lit(empty).alias("empty_list"), "rows"))
    return reduce(DataFrame.unionByName, counts)


def _order_overview(spark, sf_dir, sel=P.SELECTION):
    """The overview's sections that need no line detail, from orders summed up."""
    return O.overview_of_orders(order_totals(spark, sf_dir), sel["years"], sel["regions"], sel["channels"])


def q_overview_kpis(spark, sf_dir):
    return _order_overview(spark, sf_dir)["metrics"]


def q_empty_overview(spark, sf_dir):
    return _order_overview(spark, sf_dir, P.EMPTY_SELECTION)["metrics"]


def q_kpi_cards(spark, sf_dir):
    """The overview metrics as display text (``$1,234``, ``12.34%``, ``1,234``)."""
    m = _order_overview(spark, sf_dir)["metrics"]
    return m.select(
        money_text(S.TOTAL_REVENUE).alias("total_revenue_text"),
        money_text(S.TOTAL_PROFIT).alias("total_profit_text"),
        percent_text("avg_margin").alias("avg_margin_text"),
        count_text("order_count").alias("order_count_text"),
    )


def q_record_kpis(spark, sf_dir):
    cols = (S.UNIT_PRICE, S.UNIT_COST, S.TOTAL_REVENUE, S.TOTAL_PROFIT)
    return O.record_kpis(_fact(spark, sf_dir, *cols))


def q_monthly_trend(spark, sf_dir):
    return _order_overview(spark, sf_dir)["monthly"]


def q_top_items_by_profit(spark, sf_dir):
    """Lines are summed per order and item type before they meet their order."""
    sel = P.SELECTION
    sums = order_item_totals(spark, sf_dir)
    return A.top_by_profit(optional_filter(sums, sel["years"], sel["regions"], sel["channels"]), S.ITEM_TYPE, 10)


def q_overview_by_region(spark, sf_dir):
    return _order_overview(spark, sf_dir)["by_region"]


def q_top_countries_by_profit(spark, sf_dir):
    return A.top_by_profit(order_totals(spark, sf_dir), S.COUNTRY, 10)


def _preview_rows(spark, sf_dir, n, sel, newest):
    """The selected lines of the days that hold the first (or last) ``n`` of them.

    Orders are counted by day, without their lines; the days that hold ``n``
    orders reach the scan as a pushed filter.  Orders may have no line, so the
    lines are counted up to ``n``, and more days taken if they don't suffice.
    """
    orders = order_dimension(spark, sf_dir)
    orders = optional_filter(orders, sel["years"], sel["regions"], sel["channels"])
    per_day = orders.groupBy(S.ORDER_DATE).agg(F.count(F.lit(1)).alias("n")).persist()
    lines = optional_filter(_fact(spark, sf_dir), sel["years"], sel["regions"], sel["channels"])
    try:
        wanted = n
        while (day := first_days(per_day, S.ORDER_DATE, wanted, newest)) is not None:
            cut = F.lit(day.isoformat(" ")).cast("timestamp_ntz")
            rows = lines.where(F.col(S.ORDER_DATE) >= cut if newest else F.col(S.ORDER_DATE) <= cut)
            if rows.select(S.ORDER_ID).limit(n).count() == n:
                return rows
            wanted *= 8
    finally:
        per_day.unpersist()
    return lines


def q_preview_latest(spark, sf_dir):
    return O.preview_latest(_preview_rows(spark, sf_dir, 200, P.SELECTION, newest=True), 200)


def q_preview_first(spark, sf_dir):
    return O.preview_first(_preview_rows(spark, sf_dir, 100, P.NO_SELECTION, newest=False), 100)


def q_preview_records(spark, sf_dir):
    """The latest preview handed out as JSON records, and those read back."""
    preview = q_preview_latest(spark, sf_dir)
    path = write_table(preview, scratch_path(spark, "records"), fmt="json")
    return spark.read.schema(preview.schema).json(path)


def q_event_time_enrich(spark, sf_dir):
    enriched = O.with_backend_columns(_fact(spark, sf_dir))
    return enriched.select(
        *S.ROW_KEY, S.ORDER_DATE, S.EVENT_TIME, S.YEAR, S.MONTH, S.MARGIN_PCT
    )


PAGE_COLUMNS = [
    S.REGION,
    S.COUNTRY,
    S.ITEM_TYPE,
    S.ORDER_DATE,
    S.UNITS_SOLD,
    S.TOTAL_REVENUE,
    S.TOTAL_PROFIT,
    *S.ROW_KEY,
]


def _page(spark, sf_dir, request=P.PAGE, index=None):
    """Sections of a page request, plus its spec.

    ``index`` is the path of a position index that is kept (``PG.extend_index``);
    without one it is written for this request, from keys alone.  It gives the
    total that clamps the cursor, the event times and order ranges that the
    page covers and where each begins.  The days of those times reach the scan
    of the orders, and only their lines are joined and ranked.
    """
    path = index or scratch_path(spark, "position-index")
    added = None if index else PG.extend_index(line_counts(spark, sf_dir), path)
    if added is None:
        counts = PG.read_index(spark, path)
        total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    else:  # one addition: its entries are distinct
        counts, total = spark.read.schema(PG.INDEX_SCHEMA).parquet(path), added
    spec = PG.clamp_page(total, **request)
    entries = PG.covered_entries(counts, spec)
    times = [e[S.EVENT_TIME] for e in entries if e[S.EVENT_TIME] is not None]
    covered = spark.createDataFrame(entries, PG.COVERED_SCHEMA)
    events = _fact(spark, sf_dir, *PAGE_COLUMNS)
    if len(times) == len(entries) > 0:
        # an order date is at most a day before its event time
        days = [F.lit(t.isoformat(" ")).cast("timestamp_ntz") for t in (min(times) - dt.timedelta(days=1), max(times))]
        events = events.where(F.col(S.ORDER_DATE).between(*days))
    events = PG.with_position_columns(events)
    spec, sections = PG.page_sections(events, total, **request, covered=covered)
    return sections, spec


def _status(spark, sf_dir, request):
    """The page's status needs the row count only."""
    return PG.page_status(spark, PG.clamp_page(q_row_count(spark, sf_dir).first()["rows"], **request))


def q_event_page(spark, sf_dir, request=P.PAGE):
    sections, _ = _page(spark, sf_dir, request)
    return O.as_output(
        sections["page"].select(
            "pos",
            S.EVENT_TIME,
            *S.ROW_KEY,
            S.REGION,
            S.COUNTRY,
            S.ITEM_TYPE,
            S.UNITS_SOLD,
            S.TOTAL_REVENUE,
            S.TOTAL_PROFIT,
        )
    )


def q_batch_metrics(spark, sf_dir):
    return _page(spark, sf_dir)[0]["metrics"]


def q_hourly_revenue(spark, sf_dir):
    return _page(spark, sf_dir)[0]["hourly_revenue"]


def q_window_top_countries(spark, sf_dir):
    return _page(spark, sf_dir)[0]["by_country"]


def q_event_page_deep(spark, sf_dir):
    """A page beyond any report-sized top-k: the cursor near the end of the table."""
    return q_event_page(spark, sf_dir, P.PAGE_DEEP)


def q_page_status(spark, sf_dir):
    return _status(spark, sf_dir, P.PAGE)


def q_page_status_default(spark, sf_dir):
    return _status(spark, sf_dir, P.PAGE_DEFAULT)


def q_page_status_clamped(spark, sf_dir):
    return _status(spark, sf_dir, P.PAGE_CLAMPED)


def q_orders_per_72h_rows(spark, sf_dir):
    """Orders per 72-hour window, counted by id and by row."""
    return A.orders_per_window(order_table(spark, sf_dir), duration="72 hours", rows_alias="order_rows")


def q_margin_extremes_text(spark, sf_dir):
    """Lowest and highest rounded margin as whole-percent text."""
    m = q_margin_extremes(spark, sf_dir)
    return m.select(*[F.concat(F.col(c).cast("int").cast("string"), F.lit("%")).alias(c) for c in m.columns])


def q_csv_sales_scan(spark, sf_dir):
    """The sales fact written as a sales CSV and read through the CSV source."""
    path = write_sales_csv(_fact(spark, sf_dir, *S.SALES_COLUMNS), scratch_path(spark, "sales-csv"))
    return O.as_output(read_sales_csv(spark, path))


def q_csv_rejects(spark, sf_dir):
    """The sales fact delivered as CSV with defects: what the scan rejects, per value."""
    sales = _fact(spark, sf_dir, *S.SALES_COLUMNS)
    folders = write_defective_landing(sales, scratch_path(spark, "defective-csv"))
    rejects = csv_rejects(spark, folders)
    # The raw record of a wrong field count holds doubles as each engine prints them.
    value = F.when(F.col("column_name").isNotNull(), F.col("value"))
    return rejects.withColumn("value", value)


def q_order_count_by_month_and_total(spark, sf_dir):
    """Distinct orders by month, by region and in all, merged from one table of bitmaps."""
    rows = _fact(spark, sf_dir, S.ORDER_ID, S.ORDER_DATE, S.REGION).select(
        month_label(S.ORDER_DATE).alias(S.MONTH), S.REGION, S.ORDER_ID
    )
    path = scratch_path(spark, "order-bitmaps")
    id_bitmaps(rows, [S.MONTH, S.REGION], S.ORDER_ID).write.parquet(path)
    bitmaps = spark.read.parquet(path)
    none = F.lit(None).cast("string")
    counts = {
        "month": count_ids(bitmaps, [S.MONTH], "order_count").withColumnRenamed(S.MONTH, "name"),
        "region": count_ids(bitmaps, [S.REGION], "order_count").withColumnRenamed(S.REGION, "name"),
        "all": count_ids(bitmaps, [], "order_count").withColumn("name", none),
    }
    parts = [c.select(F.lit(level).alias("level"), "name", "order_count") for level, c in counts.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_sales_cube(spark, sf_dir):
    """The summary written once, then grouping sets over it (nullable whole numbers as text or double)."""
    cube = sales_cube(write_summary(spark, sf_dir))
    return cube.withColumns(
        {S.YEAR: F.col(S.YEAR).cast("string"), "order_count": F.col("order_count").cast("double")}
    )


def q_summary_monthly_trend(spark, sf_dir):
    """The overview's monthly trend from the summary: no star pass beside the one that wrote it."""
    sel = P.SELECTION
    return O.overview_of_orders(write_summary(spark, sf_dir), sel["years"], sel["regions"], sel["channels"])["monthly"]


def q_summary_kpis(spark, sf_dir):
    """The overview's metrics from the summary."""
    sel = P.SELECTION
    return O.overview_of_orders(write_summary(spark, sf_dir), sel["years"], sel["regions"], sel["channels"])["metrics"]


def q_serving_table(spark, sf_dir):
    return _page(spark, sf_dir)[0]["serving_table"]


def q_strict_dates(spark, sf_dir):
    orders = order_table(spark, sf_dir)
    text = orders.select(
        S.ORDER_ID, F.date_format(S.ORDER_DATE, C.SALES_DATE_FORMAT).alias("order_date_text")
    )
    return text.withColumns(
        {
            S.ORDER_DATE: C.strict_timestamp("order_date_text"),
            "order_day": C.strict_date("order_date_text").cast("string"),
        }
    )


def q_coerce_clean(spark, sf_dir):
    raw = orders_as_text(spark, sf_dir)
    typed = raw.withColumn(S.ORDER_DATE, C.lenient_timestamp(S.ORDER_DATE))
    typed = C.coerce_numeric(typed, {S.ORDER_ID: "bigint", "total_price": "double"})
    return C.drop_null(typed, [S.ORDER_DATE]).select(
        S.ORDER_ID, S.ORDER_DATE, "total_price", S.ORDER_PRIORITY
    )


def q_synthetic_orders(spark, sf_dir):
    keys = read_table(spark, sf_dir, "orders").select("o_orderkey")
    return O.as_output(synthetic_sales_from_index(keys, "o_orderkey"))


def q_source_choice(spark, sf_dir):
    """The tables have no sales CSV: demo rows (one per order) are chosen, and say so."""
    keys = read_table(spark, sf_dir, "orders").select("o_orderkey")
    source, rows = sales_or_demo(spark, f"{sf_dir}/sales.csv", synthetic_sales_from_index(keys, "o_orderkey"))
    return O.as_output(rows.select(F.lit(source).alias("source"), S.ORDER_ID, S.ORDER_DATE, S.TOTAL_REVENUE))


def q_orders_by_priority(spark, sf_dir):
    return A.orders_by_priority(order_table(spark, sf_dir))


def q_margin_by_item(spark, sf_dir):
    return A.margin_by_item(_fact(spark, sf_dir, S.ITEM_TYPE, S.UNIT_PRICE, S.UNIT_COST))


QUERIES: dict[str, Builder] = {
    "sales_fact": q_sales_fact,
    "row_count": q_row_count,
    "profit_by_region": q_profit_by_region,
    "top_profit_region": q_top_profit_region,
    "top_country_in_top_region": q_top_country_in_top_region,
    "top_region_lines": q_top_region_lines,
    "top_region_lines_of_copy": q_top_region_lines_of_copy,
    "orders_per_72h": q_orders_per_72h,
    "max_orders_72h": q_max_orders_72h,
    "sliding_72h": q_sliding_72h,
    "avg_units_by_month": q_avg_units_by_month,
    "best_month_by_units": q_best_month_by_units,
    "order_margin_pct": q_order_margin_pct,
    "margin_extremes": q_margin_extremes,
    "top3_orders_per_item": q_top3_orders_per_item,
    "weekend_units_by_item": q_weekend_units_by_item,
    "weekend_top5": q_weekend_top5,
    "yoy_growth_label": q_yoy_growth_label,
    "yoy_growth_pct": q_yoy_growth_pct,
    "filter_options": q_filter_options,
    "filtered_orders": q_filtered_orders,
    "filtered_orders_strict": q_filtered_orders_strict,
    "filtered_orders_strict_empty": q_filtered_orders_strict_empty,
    "overview_kpis": q_overview_kpis,
    "empty_overview": q_empty_overview,
    "kpi_cards": q_kpi_cards,
    "record_kpis": q_record_kpis,
    "monthly_trend": q_monthly_trend,
    "top_items_by_profit": q_top_items_by_profit,
    "overview_by_region": q_overview_by_region,
    "top_countries_by_profit": q_top_countries_by_profit,
    "preview_latest": q_preview_latest,
    "preview_first": q_preview_first,
    "preview_records": q_preview_records,
    "event_time_enrich": q_event_time_enrich,
    "event_page": q_event_page,
    "batch_metrics": q_batch_metrics,
    "hourly_revenue": q_hourly_revenue,
    "window_top_countries": q_window_top_countries,
    "event_page_deep": q_event_page_deep,
    "page_status": q_page_status,
    "page_status_default": q_page_status_default,
    "page_status_clamped": q_page_status_clamped,
    "serving_table": q_serving_table,
    "orders_per_72h_rows": q_orders_per_72h_rows,
    "margin_extremes_text": q_margin_extremes_text,
    "csv_sales_scan": q_csv_sales_scan,
    "csv_rejects": q_csv_rejects,
    "order_count_by_month_and_total": q_order_count_by_month_and_total,
    "sales_cube": q_sales_cube,
    "summary_monthly_trend": q_summary_monthly_trend,
    "summary_kpis": q_summary_kpis,
    "strict_dates": q_strict_dates,
    "coerce_clean": q_coerce_clean,
    "synthetic_orders": q_synthetic_orders,
    "source_choice": q_source_choice,
    "orders_by_priority": q_orders_by_priority,
    "margin_by_item": q_margin_by_item,
}
