"""SQL over temp views; the stored-views flow (views job -> store ->
featured job); the grid backfill writer."""

from pyspark.sql import functions as F

from clickpanes.operators.featured import featured_products
from clickpanes.plans import catalog
from clickpanes.plans.featured import featured_from_clicks
from clickpanes.plans.grid import backfill_grid
from clickpanes.plans.sql import register_views, views_sql
from clickpanes.sinks import write_views
from clickpanes.sources.files import read_views
from conftest import SF_SMALL


def test_views_sql_equals_operators(spark):
    sql, ops = views_sql(spark, SF_SMALL), catalog.views(spark, SF_SMALL)
    assert sql.exceptAll(ops).count() == 0 and ops.exceptAll(sql).count() == 0


def test_registered_views_are_named_tables(spark):
    frames = register_views(spark, SF_SMALL)
    assert {"click_lines", "click_times", "zip_states", "products"} <= set(frames)
    assert spark.table("click_lines").count() == frames["click_lines"].count()


def test_featured_from_stored_views(spark, scratch):
    store = scratch("views-store")
    write_views(catalog.views(spark, SF_SMALL), store)
    stored = read_views(spark, store)
    p = catalog.products(spark, SF_SMALL)
    for date in ("2024-01-01", "2024-01-05"):
        a = featured_products(stored, date, p)
        b = featured_from_clicks(catalog.clicks_with_state(spark, SF_SMALL), date, p)
        assert a.collect() == b.collect()


def test_backfill_grid_writes_positive_rows_by_hour(spark, scratch):
    out = scratch("grid")
    views = catalog.views(spark, SF_SMALL)
    backfill_grid(views, out, "2024-01-01 00:55:00", 23, 300)
    back = read_views(spark, out)
    day = views.filter(
        (F.col("period_start") >= F.lit("2024-01-01 01:00:00").cast("timestamp"))
        & (F.col("period_start") <= F.lit("2024-01-01 02:55:00").cast("timestamp"))
    )
    assert back.filter(F.col("count") <= 0).count() == 0
    assert back.exceptAll(day).count() == 0 and day.exceptAll(back).count() == 0
