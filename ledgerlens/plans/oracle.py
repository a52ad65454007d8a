"""DuckDB oracle SQL for the catalogue queries.

Each statement is written independently of the Spark code, in plain SQL over
the driver tables, with the same output column names and types.  Conventions
shared with the Spark side:

* money is summed as DECIMAL and cast to DOUBLE afterwards;
* means are ``CAST(exact sum AS DOUBLE) / count``;
* ``round(x, 2) + 0.0`` turns DuckDB's negative zero into zero;
* weekdays are ``isodow(d) - 1`` (Monday = 0);
* 72-hour buckets are aligned to the epoch explicitly.
"""

from __future__ import annotations



# The requests of the queries, stated here on their own: a wrong request
# parameter of the Spark side must not shift both sides.
_SELECTION = {"years": [1996, 1997], "regions": ["ASIA", "EUROPE"]}
_STRICT = {"years": [1996, 1997], "regions": ["ASIA", "EUROPE"], "channels": ["AUTOMOBILE", "BUILDING"]}
_EMPTY = {"years": [1990]}
_PAGE = {"batch_size": 30, "stream_cursor": 5000, "lookback_batches": 4}
_PAGE_DEEP = {"batch_size": 60, "stream_cursor": 55_000, "lookback_batches": 5}
_PAGE_DEFAULT = {"batch_size": 30, "stream_cursor": None, "lookback_batches": 4}
_PAGE_CLAMPED = {"batch_size": 500, "stream_cursor": 10**12, "lookback_batches": 0}


def _in(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


SALES = """
sales AS (
  SELECT r.r_name AS region,
         n.n_name AS country,
         p.p_type AS item_type,
         c.c_mktsegment AS sales_channel,
         o.o_orderpriority AS order_priority,
         o.o_orderdate AS order_date,
         l.l_orderkey AS order_id,
         l.l_shipdate AS ship_date,
         CAST(l.l_quantity AS DECIMAL(12,2)) AS units_sold,
         l.l_extendedprice / NULLIF(l.l_quantity, 0) AS unit_price,
         p.p_retailprice AS unit_cost,
         CAST(CAST(l.l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))
              AS DECIMAL(18,4)) AS total_revenue,
         CAST(CAST(l.l_quantity AS DECIMAL(12,2)) * CAST(p.p_retailprice AS DECIMAL(12,2))
              AS DECIMAL(18,4)) AS total_cost,
         CAST(CAST(l.l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))
              AS DECIMAL(18,4))
           - CAST(CAST(l.l_quantity AS DECIMAL(12,2)) * CAST(p.p_retailprice AS DECIMAL(12,2))
              AS DECIMAL(18,4)) AS total_profit,
         l.l_linenumber AS line_number,
         l.l_partkey AS part_key,
         l.l_suppkey AS supp_key,
         l.l_extendedprice AS ext_price
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

FACT_OUT = """region, country, item_type, sales_channel, order_priority, order_date, order_id,
  ship_date, CAST(units_sold AS DOUBLE) AS units_sold, unit_price, unit_cost,
  CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(total_cost AS DOUBLE) AS total_cost,
  CAST(total_profit AS DOUBLE) AS total_profit, line_number, part_key, supp_key, ext_price"""

ROW_KEY = "order_id, line_number, part_key, supp_key, ext_price"

MARGIN_TOTAL = (
    "ROUND(CAST(total_profit AS DOUBLE) / NULLIF(CAST(total_revenue AS DOUBLE), 0) * 100.0, 2) + 0.0"
)
MARGIN_UNIT = "ROUND((unit_price - unit_cost) / NULLIF(unit_price, 0) * 100.0, 2) + 0.0"
EVENT_TIME = (
    "order_date + to_hours(CAST(((order_id % 24) + 24) % 24 AS BIGINT))"
    " + to_minutes(CAST(((order_id % 60) + 60) % 60 AS BIGINT))"
)
BUCKET_72H = "time_bucket(INTERVAL '72 hours', o_orderdate, TIMESTAMP '1970-01-01')"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _years(years) -> str:
    return f"CAST(year(order_date) AS INTEGER) IN ({_in(years)})"


def _selection(sel: dict) -> str:
    """WHERE clause of the optional (API) selection."""
    preds = []
    if sel.get("years"):
        preds.append(_years(sel["years"]))
    if sel.get("regions"):
        preds.append(f"region IN ({_in(sel['regions'])})")
    if sel.get("channels"):
        preds.append(f"sales_channel IN ({_in(sel['channels'])})")
    return " AND ".join(preds) if preds else "TRUE"


def _strict_selection(sel: dict) -> str:
    preds = []
    for key, col in (("regions", "region"), ("channels", "sales_channel")):
        vals = sel.get(key)
        if vals is None:
            continue
        preds.append(f"{col} IN ({_in(vals)})" if vals else "FALSE")
    if sel.get("years") is not None:
        preds.append(_years(sel["years"]) if sel["years"] else "FALSE")
    return " AND ".join(preds) if preds else "TRUE"


SEL = _selection(_SELECTION)

_KPIS = f"""SELECT count(*) = 0 AS empty,
       CAST(sum(total_revenue) AS DOUBLE) AS total_revenue,
       CAST(sum(total_profit) AS DOUBLE) AS total_profit,
       CAST(sum(CAST(m AS DECIMAL(18,2))) AS DOUBLE) / NULLIF(count(m), 0) AS avg_margin,
       count(DISTINCT order_id) AS order_count
FROM (SELECT *, {MARGIN_TOTAL} AS m FROM sales WHERE {{where}}) t"""

def _page_ctes(request: dict) -> tuple[str, ...]:
    batch = max(5, min(request["batch_size"], 120))
    lookback = max(1, min(request["lookback_batches"], 10))
    cursor = 4 * batch if request["stream_cursor"] is None else request["stream_cursor"]
    return (
        SALES,
        f"ev AS (SELECT *, {EVENT_TIME} AS event_time FROM sales)",
        f"spec AS (SELECT count(*) AS total, GREATEST({batch}, LEAST({cursor}, count(*))) AS cursor FROM ev)",
        f"ranked AS (SELECT *, row_number() OVER (ORDER BY event_time, {ROW_KEY}) - 1 AS pos FROM ev)",
        f"""page AS (SELECT ranked.*, (SELECT cursor FROM spec) AS cursor FROM ranked
  WHERE pos >= GREATEST(0, (SELECT cursor FROM spec) - {batch * lookback})
    AND pos < (SELECT cursor FROM spec))""",
        f"""status AS (SELECT (SELECT count(*) FROM page) = 0 AS empty, total AS total_rows,
  CAST({batch} AS BIGINT) AS batch_size, CAST(cursor AS BIGINT) AS stream_cursor,
  CAST({lookback} AS BIGINT) AS lookback_batches FROM spec)""",
    )


_PAGE_CTES = _page_ctes(_PAGE)
_PAGE_ROWS = """SELECT CAST(pos AS BIGINT) AS pos, event_time, order_id, line_number, part_key, supp_key,
       ext_price, region, country, item_type, CAST(units_sold AS DOUBLE) AS units_sold,
       CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(total_profit AS DOUBLE) AS total_profit
FROM page"""

_SYN_DAY = "CAST(o_orderkey AS INTEGER)"


def _pick(values, idx: str) -> str:
    return f"[{_in(values)}][({idx}) % {len(values)} + 1]"


_SYN = f"""syn AS (
  SELECT o_orderkey AS i,
         CAST(60 + o_orderkey % 140 AS DECIMAL(12,2)) AS units,
         CAST(20 + (o_orderkey * 3) % 80 AS DECIMAL(12,2)) AS price,
         DATE '2022-01-01' + {_SYN_DAY} AS d
  FROM orders),
syn2 AS (
  SELECT *, ROUND(price * CAST(0.62 AS DECIMAL(4,2)), 2) AS cost,
         CAST(ROUND(units * price, 2) AS DECIMAL(18,4)) AS revenue
  FROM syn),
syn3 AS (
  SELECT *, CAST(ROUND(units * cost, 2) AS DECIMAL(18,4)) AS tcost FROM syn2)"""


ORACLE_SQL: dict[str, str] = {
    "sales_fact": _with(SALES) + f"SELECT {FACT_OUT} FROM sales",
    "row_count": _with(SALES) + "SELECT count(*) AS rows FROM sales",
    "profit_by_region": _with(SALES)
    + "SELECT region, CAST(sum(total_profit) AS DOUBLE) AS total_profit FROM sales GROUP BY region",
    "top_profit_region": _with(SALES)
    + """SELECT region, CAST(sum(total_profit) AS DOUBLE) AS total_profit FROM sales
GROUP BY region ORDER BY total_profit DESC, region LIMIT 1""",
    "top_country_in_top_region": _with(
        SALES,
        "rc AS (SELECT region, country, sum(total_profit) AS p FROM sales GROUP BY region, country)",
        "r AS (SELECT region, sum(p) AS rp FROM rc GROUP BY region ORDER BY rp DESC, region LIMIT 1)",
    )
    + """SELECT r.region, CAST(r.rp AS DOUBLE) AS region_profit, rc.country,
       CAST(rc.p AS DOUBLE) AS total_profit
FROM rc JOIN r ON rc.region = r.region ORDER BY rc.p DESC, rc.country LIMIT 1""",
    "top_region_lines": _with(
        SALES,
        """best AS (SELECT region FROM sales GROUP BY region
             ORDER BY CAST(sum(total_profit) AS DOUBLE) DESC, region LIMIT 1)""",
    )
    + f"SELECT {FACT_OUT} FROM sales WHERE region IN (SELECT region FROM best)",
    "orders_per_72h": f"""SELECT {BUCKET_72H} AS window_start,
       {BUCKET_72H} + INTERVAL '72 hours' AS window_end,
       count(o_orderkey) AS count_order_id
FROM orders GROUP BY 1, 2""",
    "orders_per_72h_rows": f"""SELECT {BUCKET_72H} AS window_start,
       {BUCKET_72H} + INTERVAL '72 hours' AS window_end,
       count(o_orderkey) AS count_order_id, count(*) AS order_rows
FROM orders GROUP BY 1, 2""",
    "margin_extremes_text": _with(SALES)
    + """SELECT CAST(CAST(min(p) AS INTEGER) AS VARCHAR) || '%' AS lowest_margin_pct,
       CAST(CAST(max(p) AS INTEGER) AS VARCHAR) || '%' AS highest_margin_pct FROM (
  SELECT ROUND((unit_price - unit_cost) / NULLIF(unit_price, 0) * 100.0) + 0.0 AS p FROM sales) t""",
    "max_orders_72h": f"""SELECT max(c) AS max_orders FROM (
  SELECT count(o_orderkey) AS c FROM orders GROUP BY {BUCKET_72H}) t""",
    "sliding_72h": "SELECT ws AS window_start, ws + INTERVAL '72 hours' AS window_end,\n"
    "       count(o_orderkey) AS count_order_id\nFROM (\n"
    + "\n  UNION ALL\n".join(
        f"  SELECT o_orderkey, time_bucket(INTERVAL '1 day', o_orderdate, TIMESTAMP '1970-01-01')"
        f" - INTERVAL '{k} days' AS ws FROM orders"
        for k in range(3)
    )
    + ") s\nGROUP BY ws",
    "avg_units_by_month": _with(SALES)
    + """SELECT CAST(month(order_date) AS INTEGER) AS month,
       CAST(sum(units_sold) AS DOUBLE) / count(units_sold) AS avg_units_sold
FROM sales GROUP BY 1""",
    "best_month_by_units": _with(SALES)
    + """SELECT CAST(month(order_date) AS INTEGER) AS month,
       CAST(sum(units_sold) AS DOUBLE) / count(units_sold) AS avg_units_sold
FROM sales GROUP BY 1 ORDER BY avg_units_sold DESC, month LIMIT 1""",
    "order_margin_pct": _with(SALES)
    + """SELECT order_id, unit_price AS sp, unit_cost AS cp,
       ROUND((unit_price - unit_cost) / NULLIF(unit_price, 0) * 100.0) + 0.0 AS percentage
FROM sales""",
    "margin_extremes": _with(SALES)
    + """SELECT min(p) AS lowest_margin_pct, max(p) AS highest_margin_pct FROM (
  SELECT ROUND((unit_price - unit_cost) / NULLIF(unit_price, 0) * 100.0) + 0.0 AS p FROM sales) t""",
    "top3_orders_per_item": _with(SALES)
    + f"""SELECT {FACT_OUT} FROM (
  SELECT *, row_number() OVER (PARTITION BY item_type ORDER BY total_profit DESC, {ROW_KEY}) AS rn
  FROM sales) t WHERE rn <= 3""",
    "weekend_units_by_item": _with(SALES)
    + f"""SELECT item_type, CAST(sum(units_sold) AS DOUBLE) AS sum_units_sold FROM sales
WHERE region = 'AFRICA' AND isodow(order_date) - 1 IN (5, 6)
GROUP BY item_type""",
    "weekend_top5": _with(SALES)
    + f"""SELECT item_type, CAST(sum(units_sold) AS DOUBLE) AS sum_units_sold FROM sales
WHERE region = 'AFRICA' AND isodow(order_date) - 1 IN (5, 6)
GROUP BY item_type ORDER BY sum_units_sold DESC, item_type LIMIT 5""",
    "yoy_growth_label": _with(
        SALES,
        """y AS (SELECT CAST(year(order_date) AS INTEGER) AS year,
              CAST(sum(total_revenue) AS DOUBLE) AS yearly_revenue FROM sales GROUP BY 1)""",
        "g AS (SELECT *, lag(yearly_revenue) OVER (ORDER BY year) AS prev FROM y)",
    )
    + """SELECT year, yearly_revenue,
       CAST(CAST(ROUND((yearly_revenue - prev) / NULLIF(prev, 0) * 100.0) AS INTEGER) AS VARCHAR)
         || ' %' AS yoy_growth
FROM g""",
    "yoy_growth_pct": _with(
        SALES,
        """y AS (SELECT CAST(year(order_date) AS INTEGER) AS year,
              CAST(sum(total_revenue) AS DOUBLE) AS total_revenue FROM sales GROUP BY 1)""",
        "g AS (SELECT *, lag(total_revenue) OVER (ORDER BY year) AS prev FROM y)",
    )
    + """SELECT year, total_revenue, (total_revenue / NULLIF(prev, 0) - 1.0) * 100.0 AS yoy_growth_pct
FROM g""",
    "filter_options": _with(SALES)
    + """SELECT kind, value FROM (
  SELECT 'year' AS kind, CAST(CAST(year(order_date) AS INTEGER) AS VARCHAR) AS value FROM sales
  UNION SELECT 'region', region FROM sales
  UNION SELECT 'channel', sales_channel FROM sales) t
WHERE value IS NOT NULL""",
    "filtered_orders": _with(SALES) + f"SELECT {FACT_OUT} FROM sales WHERE {SEL}",
    "filtered_orders_strict": _with(SALES)
    + f"SELECT {FACT_OUT} FROM sales WHERE {_strict_selection(_STRICT)}",
    "filtered_orders_strict_empty": _with(SALES)
    + """SELECT * FROM (VALUES ('years', 0), ('regions', 0), ('channels', 0)) v(empty_list, rows)
UNION ALL SELECT 'none', count(*) FROM sales WHERE year(order_date) IN (1996, 1997) AND region IN ('ASIA', 'EUROPE')
  AND sales_channel IN ('AUTOMOBILE', 'BUILDING')""",
    "overview_kpis": _with(SALES) + _KPIS.format(where=SEL),
    "empty_overview": _with(SALES) + _KPIS.format(where=_selection(_EMPTY)),
    "kpi_cards": _with(SALES, "k AS (" + _KPIS.format(where=SEL) + ")")
    + """SELECT '$' || format('{:,.0f}', total_revenue) AS total_revenue_text,
       '$' || format('{:,.0f}', total_profit) AS total_profit_text,
       format('{:,.2f}', avg_margin) || '%' AS avg_margin_text,
       format('{:,}', order_count) AS order_count_text
FROM k""",
    "record_kpis": _with(SALES)
    + f"""SELECT count(*) AS rows,
       CAST(sum(total_revenue) AS DOUBLE) AS total_revenue,
       CAST(sum(total_profit) AS DOUBLE) AS total_profit,
       CAST(sum(CAST(m AS DECIMAL(18,2))) AS DOUBLE) / NULLIF(count(m), 0) AS avg_margin
FROM (SELECT *, {MARGIN_UNIT} AS m FROM sales) t""",
    "monthly_trend": _with(SALES)
    + f"""SELECT strftime(order_date, '%Y-%m') AS month,
       CAST(sum(total_revenue) AS DOUBLE) AS total_revenue,
       CAST(sum(total_profit) AS DOUBLE) AS total_profit
FROM sales WHERE {SEL} GROUP BY 1""",
    "top_items_by_profit": _with(SALES)
    + f"""SELECT item_type, CAST(sum(total_profit) AS DOUBLE) AS total_profit FROM sales
WHERE {SEL} GROUP BY item_type ORDER BY total_profit DESC, item_type LIMIT 10""",
    "overview_by_region": _with(SALES)
    + f"""SELECT region, CAST(sum(total_profit) AS DOUBLE) AS total_profit FROM sales
WHERE {SEL} GROUP BY region""",
    "top_countries_by_profit": _with(SALES)
    + """SELECT country, CAST(sum(total_profit) AS DOUBLE) AS total_profit FROM sales
GROUP BY country ORDER BY total_profit DESC, country LIMIT 10""",
    "preview_latest": _with(SALES)
    + f"""SELECT strftime(order_date, '%Y-%m-%d') AS order_date, region, country, item_type,
       sales_channel, CAST(units_sold AS DOUBLE) AS units_sold,
       CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(total_profit AS DOUBLE) AS total_profit,
       {MARGIN_TOTAL} AS margin_pct
FROM sales WHERE {SEL}
ORDER BY sales.order_date DESC, {ROW_KEY} LIMIT 200""",
    "preview_first": _with(SALES)
    + f"SELECT {FACT_OUT} FROM sales ORDER BY order_date, {ROW_KEY} LIMIT 100",
    "event_time_enrich": _with(SALES)
    + f"""SELECT order_id, line_number, part_key, supp_key, ext_price, order_date,
       {EVENT_TIME} AS event_time,
       CAST(year(order_date) AS INTEGER) AS year,
       strftime(order_date, '%Y-%m') AS month,
       {MARGIN_TOTAL} AS margin_pct
FROM sales""",
    "event_page": _with(*_PAGE_CTES) + _PAGE_ROWS,
    "event_page_deep": _with(*_page_ctes(_PAGE_DEEP)) + _PAGE_ROWS,
    "page_status": _with(*_PAGE_CTES) + "SELECT * FROM status",
    "page_status_default": _with(*_page_ctes(_PAGE_DEFAULT)) + "SELECT * FROM status",
    "page_status_clamped": _with(*_page_ctes(_PAGE_CLAMPED)) + "SELECT * FROM status",
    "csv_sales_scan": _with(SALES)
    + """SELECT trim(region) AS region, trim(country) AS country, trim(item_type) AS item_type,
       trim(sales_channel) AS sales_channel, trim(order_priority) AS order_priority,
       order_date, order_id, ship_date, CAST(units_sold AS DOUBLE) AS units_sold, unit_price, unit_cost,
       CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(total_cost AS DOUBLE) AS total_cost,
       CAST(total_profit AS DOUBLE) AS total_profit
FROM sales""",
    "batch_metrics": _with(*_PAGE_CTES)
    + f"""SELECT count(*) AS events_ingested,
       COALESCE(CAST(sum(CASE WHEN pos >= GREATEST(0, cursor - 30)
                              THEN total_revenue END) AS DOUBLE), 0.0) AS batch_revenue,
       COALESCE(CAST(sum(CASE WHEN pos >= GREATEST(0, cursor - 30)
                              THEN total_profit END) AS DOUBLE), 0.0) AS batch_profit
FROM page""",
    "hourly_revenue": _with(*_PAGE_CTES)
    + """SELECT strftime(date_trunc('hour', event_time), '%Y-%m-%d %H:%M') AS event_hour,
       CAST(sum(total_revenue) AS DOUBLE) AS total_revenue
FROM page GROUP BY 1""",
    "window_top_countries": _with(*_PAGE_CTES)
    + """SELECT country, CAST(sum(total_profit) AS DOUBLE) AS total_profit FROM page
GROUP BY country ORDER BY total_profit DESC, country LIMIT 8""",
    "serving_table": _with(*_PAGE_CTES)
    + """SELECT region, item_type, CAST(sum(total_revenue) AS DOUBLE) AS total_revenue,
       CAST(sum(total_profit) AS DOUBLE) AS total_profit,
       CAST(sum(units_sold) AS DOUBLE) AS units_sold
FROM page GROUP BY region, item_type
ORDER BY total_profit DESC, region, item_type LIMIT 20""",
    "order_count_by_month_and_total": _with(SALES)
    + """SELECT 'month' AS level, strftime(order_date, '%Y-%m') AS name, count(DISTINCT order_id) AS order_count
FROM sales GROUP BY 2
UNION ALL SELECT 'region', region, count(DISTINCT order_id) FROM sales GROUP BY 2
UNION ALL SELECT 'all', CAST(NULL AS VARCHAR), count(DISTINCT order_id) FROM sales""",
    "sales_cube": _with(
        SALES,
        f"""m AS (SELECT *, {MARGIN_TOTAL} AS margin, strftime(order_date, '%Y-%m') AS month,
          CAST(CAST(year(order_date) AS INTEGER) AS VARCHAR) AS year FROM sales)""",
    )
    + """SELECT CASE WHEN grouping(country) = 0 THEN 'country' WHEN grouping(region) = 0 THEN 'region'
            WHEN grouping(item_type) = 0 THEN 'item_type' WHEN grouping(month) = 0 THEN 'month'
            WHEN grouping(year) = 0 THEN 'year' ELSE 'all' END AS level,
       region, country, item_type, month, year,
       CAST(sum(total_revenue) AS DOUBLE) AS total_revenue,
       CAST(sum(total_profit) AS DOUBLE) AS total_profit,
       CAST(sum(units_sold) AS DOUBLE) AS units_sold,
       CAST(sum(CAST(margin AS DECIMAL(18,2))) AS DOUBLE) / NULLIF(count(margin), 0) AS avg_margin,
       count(*) AS lines,
       CAST(CASE WHEN grouping(item_type) = 1 THEN count(DISTINCT order_id) END AS DOUBLE) AS order_count
FROM m
GROUP BY GROUPING SETS ((region), (region, country), (item_type), (month), (year), ())""",
    "summary_monthly_trend": _with(SALES)
    + """SELECT strftime(order_date, '%Y-%m') AS month,
       CAST(sum(total_revenue) AS DOUBLE) AS total_revenue,
       CAST(sum(total_profit) AS DOUBLE) AS total_profit
FROM sales WHERE year(order_date) IN (1996, 1997) AND region IN ('ASIA', 'EUROPE') GROUP BY 1""",
    "summary_kpis": _with(SALES)
    + _KPIS.format(where="year(order_date) IN (1996, 1997) AND region IN ('ASIA', 'EUROPE')"),
    "preview_records": _with(SALES)
    + f"""SELECT strftime(order_date, '%Y-%m-%d') AS order_date, region, country, item_type,
       sales_channel, CAST(units_sold AS DOUBLE) AS units_sold,
       CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(total_profit AS DOUBLE) AS total_profit,
       {MARGIN_TOTAL} AS margin_pct
FROM sales WHERE {SEL}
ORDER BY sales.order_date DESC, {ROW_KEY} LIMIT 200""",
    "top_region_lines_of_copy": _with(
        SALES,
        "totals AS (SELECT region, CAST(sum(total_profit) AS DOUBLE) AS p FROM sales GROUP BY region)",
    )
    + f"""SELECT {FACT_OUT} FROM sales
WHERE region = (SELECT region FROM totals ORDER BY p DESC, region LIMIT 1)""",
    "csv_rejects": _with(
        SALES,
        """landed AS (SELECT *, order_priority = '1-URGENT' AS urgent, order_priority = '5-LOW' AS low,
           CASE WHEN order_id % 11 = 0 OR order_id % 13 = 0 THEN 1 ELSE 0 END AS miscounted FROM sales)""",
    )
    + """SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(NULL AS VARCHAR) AS column_name,
       CAST(NULL AS VARCHAR) AS value, 'wrong number of fields' AS reason FROM landed WHERE miscounted = 1
UNION ALL
SELECT CAST(order_id AS VARCHAR), 'order_date', CAST(NULL AS VARCHAR), 'missing order date'
FROM landed WHERE miscounted = 0 AND urgent AND order_id % 7 = 0
UNION ALL
SELECT CAST(order_id AS VARCHAR), 'order_date', strftime(order_date, '%-d/%-m/%Y'), 'unparsable date'
FROM landed WHERE miscounted = 0 AND low AND day(order_date) > 12
UNION ALL
SELECT CAST(order_id AS VARCHAR), 'unit_price', 'USD ' || CAST(unit_price AS VARCHAR), 'not a number'
FROM landed WHERE miscounted = 0 AND urgent""",
    "strict_dates": """SELECT o_orderkey AS order_id,
       strftime(o_orderdate, '%-m/%-d/%Y') AS order_date_text,
       strptime(strftime(o_orderdate, '%-m/%-d/%Y'), '%m/%d/%Y') AS order_date,
       strftime(o_orderdate, '%Y-%m-%d') AS order_day
FROM orders""",
    "coerce_clean": """WITH t AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
         CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%-d/%-m/%Y')
              WHEN o_orderstatus = 'P' THEN ''
              ELSE strftime(o_orderdate, '%-m/%-d/%Y') END AS order_date,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'USD ' || CAST(o_totalprice AS VARCHAR)
              ELSE CAST(o_totalprice AS VARCHAR) END AS total_price,
         o_orderpriority AS order_priority
  FROM orders)
SELECT TRY_CAST(trim(order_id) AS BIGINT) AS order_id,
       try_strptime(order_date, '%m/%d/%Y') AS order_date,
       TRY_CAST(trim(total_price) AS DOUBLE) AS total_price,
       order_priority
FROM t WHERE try_strptime(order_date, '%m/%d/%Y') IS NOT NULL""",
    "synthetic_orders": _with(_SYN)
    + f"""SELECT {_pick(['Asia', 'Europe', 'Sub-Saharan Africa', 'Middle East and North Africa',
                   'North America', 'Central America and the Caribbean'], 'i')} AS region,
       {_pick(['India', 'Germany', 'Nigeria', 'Egypt', 'United States', 'Mexico'], 'i')} AS country,
       {_pick(['Office Supplies', 'Cosmetics', 'Household', 'Baby Food', 'Clothes'], 'i')} AS item_type,
       {_pick(['Online', 'Offline'], 'i')} AS sales_channel,
       {_pick(['L', 'M', 'H', 'C'], 'i')} AS order_priority,
       CAST(d AS TIMESTAMP) AS order_date,
       100000 + i AS order_id,
       CAST(d + CAST(i % 7 + 1 AS INTEGER) AS TIMESTAMP) AS ship_date,
       CAST(units AS DOUBLE) AS units_sold,
       CAST(price AS DOUBLE) AS unit_price,
       CAST(cost AS DOUBLE) AS unit_cost,
       CAST(revenue AS DOUBLE) AS total_revenue,
       CAST(tcost AS DOUBLE) AS total_cost,
       CAST(ROUND(revenue - tcost, 2) AS DOUBLE) AS total_profit
FROM syn3""",
    "source_choice": _with(_SYN)
    + """SELECT 'demo' AS source, 100000 + i AS order_id, CAST(d AS TIMESTAMP) AS order_date,
       CAST(revenue AS DOUBLE) AS total_revenue
FROM syn3""",
    "orders_by_priority": """SELECT o_orderpriority AS order_priority, count(*) AS orders,
       count(*) / sum(count(*)) OVER () AS share
FROM orders GROUP BY o_orderpriority""",
    "margin_by_item": _with(SALES)
    + f"""SELECT item_type,
       CAST(sum(CAST(m AS DECIMAL(18,2))) AS DOUBLE) / NULLIF(count(m), 0) AS avg_margin_pct,
       count(*) AS lines
FROM (SELECT item_type, {MARGIN_UNIT} AS m FROM sales) t GROUP BY item_type""",
}
