"""Golden anchors on a small sales CSV of the tests' own, worked out by hand."""

import datetime as dt
import os

import pytest

from ledgerlens import schema as S
from ledgerlens.functions.calendar import event_time
from ledgerlens.operators import aggregates as A
from ledgerlens.operators import overview as O
from ledgerlens.operators import paging as PG
from ledgerlens.plans.questions import questions
from ledgerlens.sources.csv import read_sales_csv

CSV = os.path.join(os.path.dirname(os.path.abspath(__file__)), "sales_small.csv")


@pytest.fixture(scope="module")
def sales(spark):
    return read_sales_csv(spark, CSV).cache()


def test_scan_drops_the_row_without_a_date_and_trims_names(sales):
    assert sales.count() == 6
    assert sales.where("country = 'Avalon'").count() == 2
    first = sales.orderBy(S.ORDER_DATE).first()
    assert first[S.ORDER_DATE] == dt.datetime(2019, 6, 1) and first[S.ORDER_ID] == 101


def test_regions_and_best_country(sales):
    assert [tuple(r) for r in A.profit_by_region(sales).collect()] == [("South", 236.0), ("North", 140.0)]
    best = A.top_country_in_top_region(sales).first()
    assert (best[S.REGION], best["region_profit"], best[S.COUNTRY], best[S.TOTAL_PROFIT]) == ("South", 236.0, "Dorne", 201.0)


def test_72h_month_and_margins(sales):
    # 72-hour windows from 1970-01-01: day 18048 = 6016 * 3 is 2019-06-01, three orders in its window
    assert A.max_orders_per_window(sales).first()[0] == 3
    month = A.avg_units_by_month(sales).first()
    assert (month[S.MONTH], round(month["avg_units_sold"], 6)) == (6, round(130 / 3, 6))
    assert tuple(A.margin_extremes(sales).first()) == (25.0, 67.0)


def test_top_orders_and_weekend_units(sales):
    top = {r[S.ORDER_ID] for r in A.top3_orders_per_item(sales, 1).collect()}
    assert top == {102, 103, 106}
    # 2019-06-01 and 02 are a weekend; 2020-07-11 is a Saturday
    assert [tuple(r) for r in A.weekend_units_by_item(sales, "North").collect()] == [("Tea", 30.0)]
    assert [tuple(r) for r in A.weekend_units_by_item(sales, "South").collect()] == [("Salt", 40.0)]


def test_yearly_revenue_and_growth(sales):
    rows = [tuple(r) for r in A.yoy_growth_label(sales).collect()]
    assert rows == [(2019, 440.0, None), (2020, 420.0, "-5 %")]


def test_kpis(sales):
    k = O.kpis(sales).first()
    assert (k["empty"], k[S.TOTAL_REVENUE], k[S.TOTAL_PROFIT], k["order_count"]) == (False, 860.0, 376.0, 6)
    # margins 37.5, 37.5, 25, 37.5, 25, 67
    assert abs(k["avg_margin"] - 229.5 / 6) < 1e-9
    r = O.record_kpis(sales).first()
    assert r["rows"] == 6 and abs(r["avg_margin"] - 229.5 / 6) < 1e-9


def test_event_page_defaults(sales):
    events = sales.withColumn(S.EVENT_TIME, event_time(S.ORDER_DATE, S.ORDER_ID))
    spec, sections = PG.page_sections(events, 6, batch_size=5)
    assert tuple(sections["status"].first()) == (False, 6, 5, 6, 4)
    m = sections["metrics"].first()
    assert (m["events_ingested"], m["batch_revenue"], m["batch_profit"]) == (6, 780.0, 346.0)
    top = sections["serving_table"].first()
    assert (top[S.REGION], top[S.ITEM_TYPE], top[S.TOTAL_PROFIT]) == ("South", "Silk", 201.0)


def test_the_seven_questions_run_on_a_csv(sales):
    answers = questions(sales, "North")
    assert len(answers) == 8 and all(a.count() > 0 for a in answers.values())
