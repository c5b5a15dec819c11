"""Windowed view counts: properties and dimension edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickpanes.config import DEFAULT_WINDOW, DEV_WINDOW, ViewWindow
from clickpanes.operators.dims import with_state
from clickpanes.operators.parse import click_times
from clickpanes.operators.views import product_views, views_by_window
from clickpanes.plans import catalog
from conftest import SF_SMALL


def _clicks(spark, rows):
    return spark.createDataFrame(rows, "product_id long, state string, date_time timestamp")


def test_each_click_counted_once_per_window(spark):
    cws = catalog.clicks_with_state(spark, SF_SMALL)
    n = cws.count()
    total = product_views(cws).agg(F.sum("count")).first()[0]
    assert total == 12 * n
    dev_total = product_views(cws, DEV_WINDOW).agg(F.sum("count")).first()[0]
    assert dev_total == 5 * n


def test_pane_method_equals_window_function(spark):
    cws = catalog.clicks_with_state(spark, SF_SMALL)
    for w in (DEFAULT_WINDOW, DEV_WINDOW, ViewWindow("10 minutes", "4 minutes"), ViewWindow("1 hour", "1 hour")):
        a = product_views(cws, w)
        b = views_by_window(cws, w)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, w


def test_window_boundaries(spark):
    t = dt.datetime(2024, 1, 1, 12, 5, 0)
    out = product_views(_clicks(spark, [(1, "S", t)])).orderBy("period_start").collect()
    starts = [r.period_start for r in out]
    assert len(starts) == 12
    assert starts[0] == dt.datetime(2024, 1, 1, 11, 10) and starts[-1] == t
    assert {r.hour for r in out} == {2024010111, 2024010112}


def test_slide_longer_than_window_is_rejected():
    with pytest.raises(ValueError):
        ViewWindow("5 minutes", "10 minutes")


def test_dimension_edge_rows(spark):
    lines = spark.createDataFrame(
        [(f"1|7|{z}|1|1|2024/01/01 10:00:00",) for z in (10001, 10002, 10003, 10004, 99)],
        "value string",
    )
    dim = spark.createDataFrame(
        [(10001, "A"), (10002, "B"), (10002, "C"), (10003, "D"), (10003, "D"), (10004, None)],
        "zip_code int, state string",
    )
    got = sorted((r.state or "") for r in with_state(click_times(lines), dim).collect())
    # two states doubles the click, the exact duplicate does not,
    # NULL state and unknown zip become Unknown
    assert got == ["A", "B", "C", "D", "Unknown", "Unknown"]


def test_views_schema(spark):
    df = catalog.views(spark, SF_SMALL)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("product_id", "bigint"), ("state", "string"), ("count", "bigint"),
        ("period_start", "timestamp"), ("hour", "bigint"),
    ]


def test_key_sample_keeps_whole_keys(spark):
    from clickpanes.operators.sampling import sample_keys

    v = catalog.views(spark, SF_SMALL)
    s = sample_keys(v, "product_id", 4, 16)
    kept = {r.product_id for r in s.select("product_id").distinct().collect()}
    assert 0 < len(kept) < v.select("product_id").distinct().count()
    per_key = s.groupBy("product_id").count()
    full = v.filter(F.col("product_id").isin(list(kept))).groupBy("product_id").count()
    assert per_key.exceptAll(full).count() == 0
    # repeatable
    assert {r.product_id for r in sample_keys(v, "product_id", 4, 16).select("product_id").distinct().collect()} == kept


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_far_times_keep_their_hour(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        lines = [(f"1|7|10001|1|1|{t}",) for t in ("2200/01/01 05:00:00", "9999/12/31 00:00:00", "2147/06/01 00:30:00")]
        clicks = click_times(spark.createDataFrame(lines, "value string")).selectExpr("product_id", "'S' AS state", "date_time")
        hours = {r.hour for r in product_views(clicks).select("hour").collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert hours == {2200010104, 2200010105, 9999123023, 9999123100, 2147053123, 2147060100}


def test_clicks_without_zip_are_unknown_and_spread(spark):
    clicks = spark.range(5000).selectExpr("id AS product_id", "CAST(NULL AS int) AS zip_code", "timestamp_seconds(id) AS date_time")
    dim = spark.createDataFrame([(10001, "A"), (None, "B")], "zip_code int, state string")
    got = with_state(clicks, dim)
    assert got.count() == 5000 and got.where("state <> 'Unknown'").count() == 0
