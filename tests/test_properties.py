"""Property tests: pure rules exhaustively, Spark operators against brute force."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.functions.calendar import year_ranges
from ledgerlens.operators import paging as PG
from ledgerlens.operators.ranking import slice_rows, top_n_per_group


@given(
    total=st.integers(0, 10_000),
    batch=st.integers(-5, 500),
    cursor=st.one_of(st.none(), st.integers(-50, 20_000)),
    lookback=st.integers(-3, 40),
)
def test_clamp_page_invariants(total, batch, cursor, lookback):
    spec = PG.clamp_page(total, batch, cursor, lookback)
    assert PG.MIN_BATCH <= spec.batch <= PG.MAX_BATCH
    assert PG.MIN_LOOKBACK <= spec.lookback <= PG.MAX_LOOKBACK
    assert spec.cursor >= spec.batch
    assert spec.cursor <= max(spec.batch, total)
    assert 0 <= spec.window_start <= spec.batch_start <= spec.cursor
    assert spec.cursor - spec.window_start <= spec.batch * spec.lookback


@given(st.lists(st.integers(1900, 2100), max_size=30))
def test_year_ranges_cover_exactly(years):
    ranges = year_ranges(years)
    covered = {y for lo, hi in ranges for y in range(lo, hi)}
    assert covered == set(years)
    for (a_lo, a_hi), (b_lo, b_hi) in zip(ranges, ranges[1:]):
        assert a_hi < b_lo  # sorted, disjoint, not adjacent (adjacent ones are merged)


rows = st.lists(
    st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(-20, 20)), min_size=1, max_size=60
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, start=st.integers(0, 70), width=st.integers(0, 30))
def test_slice_rows_matches_pandas(spark, data, start, width):
    pdf = pd.DataFrame(data, columns=["t", "g", "v"]).reset_index().rename(columns={"index": "id"})
    df = spark.createDataFrame(pdf)
    order = ["t", "v", "id"]
    want = pdf.sort_values(order).reset_index(drop=True).iloc[start : start + width]
    got = slice_rows(df, order, start, start + width).orderBy("pos").toPandas()
    assert list(got["id"]) == list(want["id"])
    assert list(got["pos"]) == list(range(start, start + len(want)))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, n=st.integers(1, 4))
def test_top_n_per_group_matches_pandas(spark, data, n):
    pdf = pd.DataFrame(data, columns=["t", "g", "v"]).reset_index().rename(columns={"index": "id"})
    df = spark.createDataFrame(pdf)
    got = top_n_per_group(df, ["g"], n, [F.desc("v"), F.asc("id")]).toPandas()
    want = pdf.sort_values(["g", "v", "id"], ascending=[True, False, True]).groupby("g").head(n)
    assert sorted(got["id"]) == sorted(want["id"])


sales_like = st.lists(
    st.tuples(
        st.integers(1995, 2001),
        st.sampled_from(["ASIA", "EUROPE", "AFRICA"]),
        st.sampled_from(["BUILDING", "MACHINERY"]),
    ),
    min_size=1,
    max_size=40,
)
choice = st.one_of(st.none(), st.lists(st.integers(1994, 2002), max_size=3))
regions = st.one_of(st.none(), st.lists(st.sampled_from(["ASIA", "EUROPE", "AMERICA"]), max_size=2))
channels = st.one_of(st.none(), st.lists(st.sampled_from(["BUILDING", "HOUSEHOLD"]), max_size=2))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=sales_like, years=choice, regs=regions, chans=channels)
def test_selections_match_pandas(spark, data, years, regs, chans):
    import datetime as dt

    from ledgerlens.operators.filters import optional_filter, strict_filter

    pdf = pd.DataFrame(
        [(i, dt.datetime(y, 6, 30, 23, 30), r, c) for i, (y, r, c) in enumerate(data)],
        columns=["order_id", "order_date", "region", "sales_channel"],
    )
    df = spark.createDataFrame(pdf).withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))

    def brute(strict):
        keep = pd.Series(True, index=pdf.index)
        for values, col in ((years, None), (regs, "region"), (chans, "sales_channel")):
            if values is None or (not strict and not values):
                continue
            series = pdf["order_date"].dt.year if col is None else pdf[col]
            keep &= series.isin(values)
        return sorted(pdf[keep]["order_id"])

    got_opt = sorted(r[0] for r in optional_filter(df, years, regs, chans).select("order_id").collect())
    got_strict = sorted(r[0] for r in strict_filter(df, years, regs, chans).select("order_id").collect())
    assert got_opt == brute(strict=False)
    assert got_strict == brute(strict=True)


geo_rows = st.lists(
    st.tuples(st.sampled_from(["R1", "R2", "R3"]), st.sampled_from(["c1", "c2", "c3", "c4"]), st.integers(-50, 50)),
    min_size=1,
    max_size=40,
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=geo_rows)
def test_top_country_in_top_region_matches_pandas(spark, data):
    from decimal import Decimal

    from ledgerlens.operators.aggregates import top_country_in_top_region

    pdf = pd.DataFrame(data, columns=["region", "country", "p"])
    df = spark.createDataFrame(
        [(r, c, Decimal(p)) for r, c, p in data], "region string, country string, total_profit decimal(18,4)"
    )
    by_region = pdf.groupby("region")["p"].sum().reset_index().sort_values(["p", "region"], ascending=[False, True])
    best_region = by_region.iloc[0]["region"]
    in_best = pdf[pdf.region == best_region].groupby("country")["p"].sum().reset_index()
    best = in_best.sort_values(["p", "country"], ascending=[False, True]).iloc[0]
    row = top_country_in_top_region(df).collect()[0]
    assert (row["region"], row["country"], row["total_profit"]) == (best_region, best["country"], float(best["p"]))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 60 * 24 * 30), min_size=1, max_size=50))
def test_72h_window_counts_match_pandas_floor(spark, minutes):
    import datetime as dt

    from ledgerlens.operators.aggregates import orders_per_window

    base = dt.datetime(2012, 6, 1)
    stamps = [base + dt.timedelta(minutes=m) for m in minutes]
    pdf = pd.DataFrame({"order_date": stamps, "order_id": range(len(stamps))})
    want = pdf.groupby(pdf["order_date"].dt.floor("72h")).size().to_dict()
    df = spark.createDataFrame(pdf).withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))
    got = {r["window_start"]: r["count_order_id"] for r in orders_per_window(df).collect()}
    assert {pd.Timestamp(k): v for k, v in got.items()} == {pd.Timestamp(k): v for k, v in want.items()}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(2010, 2016), st.integers(1, 10_000)), min_size=1, max_size=30))
def test_growth_label_matches_half_up_brute_force(spark, rows):
    import datetime as dt
    from decimal import ROUND_HALF_UP, Decimal

    from ledgerlens.operators.aggregates import yoy_growth_label

    df = spark.createDataFrame(
        [(dt.datetime(y, 3, 1), Decimal(v)) for y, v in rows],
        "order_date timestamp_ntz, total_revenue decimal(18,4)",
    )
    totals = pd.DataFrame(rows, columns=["y", "v"]).groupby("y")["v"].sum().sort_index()
    want, prev = {}, None
    for year, total in totals.items():
        if prev is None:
            want[year] = None
        else:
            pct = (float(total) - float(prev)) / float(prev) * 100.0
            rounded = Decimal(repr(pct)).quantize(Decimal(1), rounding=ROUND_HALF_UP)
            want[year] = f"{int(rounded)} %"
        prev = total
    got = {r["year"]: r["yoy_growth"] for r in yoy_growth_label(df).collect()}
    assert got == want


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 400), st.sampled_from(["A", "B"]), st.integers(1, 9)), min_size=1, max_size=40))
def test_weekend_units_match_pandas_dayofweek(spark, rows):
    import datetime as dt
    from decimal import Decimal

    from ledgerlens.operators.aggregates import weekend_units_by_item

    base = dt.datetime(2015, 1, 1)
    pdf = pd.DataFrame(
        [(base + dt.timedelta(days=d), "R", item, u) for d, item, u in rows],
        columns=["order_date", "region", "item_type", "units_sold"],
    )
    df = spark.createDataFrame(
        [(r.order_date.to_pydatetime(), r.region, r.item_type, Decimal(int(r.units_sold))) for r in pdf.itertuples()],
        "order_date timestamp_ntz, region string, item_type string, units_sold decimal(12,2)",
    )
    weekend = pdf[pdf["order_date"].dt.dayofweek.isin([5, 6])]
    want = weekend.groupby("item_type")["units_sold"].sum().astype(float).to_dict()
    got = {r["item_type"]: r["sum_units_sold"] for r in weekend_units_by_item(df, "R").collect()}
    assert got == want
