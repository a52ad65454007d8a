"""Column names and fixed schemas.

The sales fact keeps the reference's fourteen business columns (snake_case)
plus four line-level keys that make every row unique; ranking and paging break
ties on them so results never depend on task order.
"""

from __future__ import annotations

from pyspark.sql import types as T

REGION = "region"
COUNTRY = "country"
ITEM_TYPE = "item_type"
SALES_CHANNEL = "sales_channel"
ORDER_PRIORITY = "order_priority"
ORDER_DATE = "order_date"
ORDER_ID = "order_id"
SHIP_DATE = "ship_date"
UNITS_SOLD = "units_sold"
UNIT_PRICE = "unit_price"
UNIT_COST = "unit_cost"
TOTAL_REVENUE = "total_revenue"
TOTAL_COST = "total_cost"
TOTAL_PROFIT = "total_profit"

LINE_NUMBER = "line_number"
PART_KEY = "part_key"
SUPP_KEY = "supp_key"
EXT_PRICE = "ext_price"

# Derived columns (backend enrichment).
EVENT_TIME = "event_time"
YEAR = "year"
MONTH = "month"
MARGIN_PCT = "margin_pct"

# Measures of one order (lines summed up, see ``sources.star.order_totals``).
LINES = "lines"
ORDERS = "orders"
MARGIN_SUM = "margin_sum"
MARGIN_LINES = "margin_lines"

SALES_COLUMNS = [
    REGION,
    COUNTRY,
    ITEM_TYPE,
    SALES_CHANNEL,
    ORDER_PRIORITY,
    ORDER_DATE,
    ORDER_ID,
    SHIP_DATE,
    UNITS_SOLD,
    UNIT_PRICE,
    UNIT_COST,
    TOTAL_REVENUE,
    TOTAL_COST,
    TOTAL_PROFIT,
]

# Columns that need the line's part, and those that need its order (and customer).
PART_COLUMNS = {ITEM_TYPE, UNIT_COST, TOTAL_COST, TOTAL_PROFIT}
ORDER_COLUMNS = {REGION, COUNTRY, SALES_CHANNEL, ORDER_PRIORITY, ORDER_DATE}

# Order id alone repeats per line; these columns together identify a line.
ROW_KEY = [ORDER_ID, LINE_NUMBER, PART_KEY, SUPP_KEY, EXT_PRICE]

FACT_COLUMNS = SALES_COLUMNS + ROW_KEY[1:]


def row_key_of(columns) -> list[str]:
    """The row-key columns present in a frame (a CSV sales file has only order_id)."""
    cols = set(columns)
    return [k for k in ROW_KEY if k in cols]


# Exact types of the money columns: sums over them are exact and do not depend
# on the order in which tasks combine partial results.
UNITS_TYPE = T.DecimalType(12, 2)
PRICE_TYPE = T.DecimalType(14, 2)
RATE_TYPE = T.DecimalType(4, 2)
MONEY_TYPE = T.DecimalType(18, 4)

# The header of the sales CSV (the input contract).
# The sales CSV as text: every column is read as a string and typed by the
# cleaning operators, so malformed values become nulls instead of failed jobs.
CSV_HEADER = [
    "Region",
    "Country",
    "Item Type",
    "Sales Channel",
    "Order Priority",
    "Order Date",
    "Order ID",
    "Ship Date",
    "Units Sold",
    "Unit Price",
    "Unit Cost",
    "Total Revenue",
    "Total Cost",
    "Total Profit",
]
CSV_TEXT_SCHEMA = T.StructType([T.StructField(name, T.StringType(), True) for name in CSV_HEADER])

# Typed sales table (what the cleaning produces from the CSV text).
SALES_SCHEMA = T.StructType(
    [
        T.StructField(REGION, T.StringType(), True),
        T.StructField(COUNTRY, T.StringType(), True),
        T.StructField(ITEM_TYPE, T.StringType(), True),
        T.StructField(SALES_CHANNEL, T.StringType(), True),
        T.StructField(ORDER_PRIORITY, T.StringType(), True),
        T.StructField(ORDER_DATE, T.TimestampNTZType(), True),
        T.StructField(ORDER_ID, T.LongType(), True),
        T.StructField(SHIP_DATE, T.TimestampNTZType(), True),
        T.StructField(UNITS_SOLD, UNITS_TYPE, True),
        T.StructField(UNIT_PRICE, T.DoubleType(), True),
        T.StructField(UNIT_COST, T.DoubleType(), True),
        T.StructField(TOTAL_REVENUE, MONEY_TYPE, True),
        T.StructField(TOTAL_COST, MONEY_TYPE, True),
        T.StructField(TOTAL_PROFIT, MONEY_TYPE, True),
    ]
)

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType(), True),
        T.StructField("ts", T.TimestampNTZType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("props", T.StringType(), True),
    ]
)
