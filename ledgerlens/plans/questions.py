"""The seven business questions as one bundle of lazy DataFrames.

Works on any typed sales frame: the star view over the driver tables or a
sales CSV read with ``ledgerlens.sources.csv.read_sales_csv``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.operators import aggregates as A
from ledgerlens.operators.ranking import top_n


def questions(sales: DataFrame, weekend_region: str) -> dict[str, DataFrame]:
    """Answers keyed by question; each value is a small lazy DataFrame."""
    return {
        "q1_best_region": A.top_profit_region(sales),
        "q1_best_country_in_best_region": A.top_country_in_top_region(sales),
        "q2_max_orders_in_72h": A.max_orders_per_window(sales),
        "q3_best_month_by_avg_units": top_n(
            A.avg_units_by_month(sales), 1, [F.desc("avg_units_sold"), F.asc(S.MONTH)]
        ),
        "q4_margin_extremes": A.margin_extremes(sales),
        "q5_top3_orders_per_item": A.top3_orders_per_item(sales),
        "q6_weekend_units_by_item": A.weekend_units_by_item(sales, weekend_region),
        "q7_yoy_growth": A.yoy_growth_label(sales),
    }
