"""The materialised fact answers like the star view and prunes year folders."""

import contextlib
import io

from conftest import SF001
from ledgerlens.operators import aggregates as A
from ledgerlens.operators import overview as O
from ledgerlens.operators.filters import optional_filter
from ledgerlens.sources.materialize import materialize_fact
from ledgerlens.sources.star import sales_fact


def test_materialised_fact_matches_view(spark):
    copy = materialize_fact(spark, SF001)
    view = sales_fact(spark, SF001)
    assert copy.count() == view.count()
    a = A.profit_by_region(copy).collect()
    b = A.profit_by_region(view).collect()
    assert a == b
    sel = dict(years=[1996, 1997], regions=["ASIA"], channels=None)
    fa = O.as_output(optional_filter(copy, **sel)).drop("order_year")
    fb = O.as_output(optional_filter(view, **sel))
    assert fa.exceptAll(fb).count() == 0 and fb.exceptAll(fa).count() == 0

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        optional_filter(copy, years=[1996]).explain("formatted")
    assert "PartitionFilters: [isnotnull(order_year" in buf.getvalue()


def test_bucketed_fact_groups_by_order_without_shuffle(spark):
    copy = materialize_fact(spark, SF001, buckets=8, table="ledgerlens_fact_bucketed")
    per_order = copy.groupBy("order_id").count()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        per_order.explain("formatted")
    assert "Exchange" not in buf.getvalue()
    assert per_order.count() == sales_fact(spark, SF001, ["order_id"]).distinct().count()


def test_rows_are_counted_from_footers(spark):
    from ledgerlens.session import scratch_path
    from ledgerlens.sources.materialize import count_rows

    path = scratch_path(spark, "counted")
    copy = materialize_fact(spark, SF001, path=path)
    rows = count_rows(spark, path, copy.schema)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        rows.explain("formatted")
    assert "PushedAggregation: [COUNT(*)]" in buf.getvalue()
    assert rows.first()["rows"] == 60000
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_chosen_region_prunes_the_copy(spark):
    import __spark_entry__ as entry

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        entry.queries()["top_region_lines_of_copy"](spark, SF001).explain("formatted")
    text = buf.getvalue()
    assert "dynamicpruning" in text and "lineitem.parquet" not in text
