"""Registered queries: each job and operator run on the shared test tables.

Every query reads the tables (``events``, ``customer``, ``nation``,
``part``, ``region``) of a scale-factor folder whole, so its work grows
with the data; a few edge rows are added (``sources.tables``). Streaming and round-trip queries write below the session's
checkpoint directory and return a batch read of what they wrote.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickpanes.config import DEFAULT_WINDOW, DEV_WINDOW
from clickpanes.functions.sampling import stable_bucket
from clickpanes.operators.dims import distinct_states, distinct_zip_states, with_state
from clickpanes.operators.featured import featured_from_store, hour_slice_stored, product_totals
from clickpanes.operators.grid import series_of, view_grid
from clickpanes.operators.parse import click_records, click_times
from clickpanes.operators.sampling import bucket_totals
from clickpanes.operators.skew import hot_keys, key_sketch, merge_sketches
from clickpanes.operators.views import pane_counts, product_views, views_by_window, views_from_panes
from clickpanes.plans.featured import day_clicks, featured_all_days, featured_from_clicks
from clickpanes.plans.grid import backfill_grid, gap_filled_views
from clickpanes.plans.record import record_clicks
from clickpanes.plans.views import publish_open_views, read_views_with_open, start_views_per_state, views_per_state
from clickpanes.schemas import CLICK_RECORD, PRODUCT_VIEWS
from clickpanes.scratch import delete_path, scratch_path, scratch_root
from clickpanes.sinks import VIEW_ORDER, read_report, write_report, write_views
from clickpanes.sources.files import (
    dev_zip_states,
    read_categories,
    read_departments,
    read_products,
    read_views,
    read_zip_states,
)
from clickpanes.sources.tables import (
    categories_from_part,
    departments_from_region,
    edge_lines,
    edge_lines_stream,
    event_lines,
    events_stream,
    products_from_part,
    read_table,
    zip_states_from_customers,
)
from clickpanes.store import compact, read_store
from clickpanes.streaming.sinks import epoch_sink, read_epochs, start_fan_out, start_file_sink

# Fixed query parameters: the report day and the grid span, 288 five-minute stamps over that day.
REPORT_DATE = "2024-01-15"
GRID_START = "2024-01-14 23:55:00"
GRID_STEPS = 287
GRID_STEP_S = 300
PRODUCT_BUCKETS = 16
# Late deliveries: periods of LATE_DAYS days from LATE_FROM on; half of the
# users deliver this much late.
LATE_FROM = "2024-01-01"
LATE_DAYS = 8
LATE_DELIVERIES = 4
LATE_DELAY = "119 MINUTES"
# The zip code that gets half of the clicks.
HOT_ZIP = 10004
# Hours up to which the late stream's store is compacted.
COMPACTED_UNTIL = (2024010912, 2024012023)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def lines(spark, sf_dir, far: bool = False) -> DataFrame:
    """Every event as a click line, and the edge rows."""
    return event_lines(_t(spark, sf_dir, "events")).union(edge_lines(spark, far))


def lines_stream(spark, sf_dir) -> DataFrame:
    """The same as a stream."""
    edges = edge_lines_stream(spark, scratch_path(spark, "edge-lines"))
    return event_lines(events_stream(spark, sf_dir)).union(edges)


def zip_states(spark, sf_dir) -> DataFrame:
    return zip_states_from_customers(_t(spark, sf_dir, "customer"), _t(spark, sf_dir, "nation"))


def products(spark, sf_dir) -> DataFrame:
    return products_from_part(_t(spark, sf_dir, "part"))


def categories(spark, sf_dir) -> DataFrame:
    return categories_from_part(_t(spark, sf_dir, "part"))


def departments(spark, sf_dir) -> DataFrame:
    return departments_from_region(_t(spark, sf_dir, "region"))


def clicks_with_state(spark, sf_dir, far: bool = False) -> DataFrame:
    return with_state(click_times(lines(spark, sf_dir, far)), zip_states(spark, sf_dir))


def views(spark, sf_dir) -> DataFrame:
    return views_per_state(lines(spark, sf_dir), zip_states(spark, sf_dir))


def day_store(spark, sf_dir, date: str = REPORT_DATE) -> DataFrame:
    """The day's views in a store partitioned by hour, as the views job
    leaves it, read back."""
    store = scratch_path(spark, "day-store")
    write_views(product_views(day_clicks(clicks_with_state(spark, sf_dir), date)), store)
    return read_views(spark, store)


# --- queries -----------------------------------------------------------


def q_parse_clicks(spark, sf_dir):
    return click_records(lines(spark, sf_dir, far=True))


def q_parse_click_times(spark, sf_dir):
    return click_times(lines(spark, sf_dir))


def q_zip_states(spark, sf_dir):
    return distinct_zip_states(zip_states(spark, sf_dir))


def q_clicks_with_state(spark, sf_dir):
    return clicks_with_state(spark, sf_dir)


def q_product_views_sliding(spark, sf_dir):
    return views(spark, sf_dir)


def q_product_views_by_window(spark, sf_dir):
    return views_by_window(clicks_with_state(spark, sf_dir), DEFAULT_WINDOW)


def q_product_views_dev(spark, sf_dir):
    return views_per_state(lines(spark, sf_dir), dev_zip_states(spark), DEV_WINDOW)


def _views_stream(spark, sf_dir, partition_by):
    out, chk = scratch_path(spark, "views-out"), scratch_path(spark, "views-chk")
    query = start_views_per_state(
        lines_stream(spark, sf_dir),
        zip_states(spark, sf_dir),
        out,
        chk,
        partition_by=partition_by,
        trigger="availableNow",
    )
    query.awaitTermination()
    delete_path(spark, chk)
    return read_views(spark, out)


def q_product_views_stream(spark, sf_dir):
    return _views_stream(spark, sf_dir, None)


def q_views_stream_by_hour(spark, sf_dir):
    """The stream's store as the job writes it, partitioned by hour."""
    return _views_stream(spark, sf_dir, "hour")


def _late_stream(spark, sf_dir, partition_by) -> str:
    """Late data on the real table: events come in deliveries, one period of
    time after another, but half of the users deliver ``LATE_DELAY`` late, so
    their last events of a period come with the next one. After each
    delivery the stream runs to the end of the available files and stops, and
    the next run resumes from the checkpoint. A late event is dropped
    for the windows that have closed by then and counted in those still open."""
    src = scratch_path(spark, "late-src")
    out, chk = scratch_path(spark, "late-out"), scratch_path(spark, "late-chk")
    delay = F.when(stable_bucket("user_id", 2) == 0, F.expr(f"INTERVAL {LATE_DELAY}")).otherwise(
        F.expr("INTERVAL 0 MINUTES")
    )
    days = F.datediff(F.col("ts") + delay, F.lit(LATE_FROM).cast("date"))
    delivery = F.least(F.greatest(F.floor(days / LATE_DAYS), F.lit(0)), F.lit(LATE_DELIVERIES - 1))
    events = _t(spark, sf_dir, "events").withColumn("delivery", delivery.cast("int"))
    dims = zip_states(spark, sf_dir)
    for k in range(LATE_DELIVERIES):
        events.filter(F.col("delivery") == k).drop("delivery").write.mode("append").parquet(src)
        query = start_views_per_state(
            event_lines(events_stream(spark, src, glob=None)),
            dims,
            out,
            chk,
            partition_by=partition_by,
            trigger="availableNow",
        )
        query.awaitTermination()
    delete_path(spark, src)
    delete_path(spark, chk)
    return out


def q_product_views_stream_late(spark, sf_dir):
    return read_views(spark, _late_stream(spark, sf_dir, None))


def q_views_compacted(spark, sf_dir):
    """The late stream's store by hour, its batches folded twice: up to a closed
    hour, and up to a later one; what comes after stays in the batches."""
    out = _late_stream(spark, sf_dir, "hour")
    for until in COMPACTED_UNTIL:
        compact(spark, out, PRODUCT_VIEWS, "hour", VIEW_ORDER, until)
    return read_views(spark, out)


def q_views_stream_with_open(spark, sf_dir):
    """The views stream's store and, from its checkpoint, the windows that are still open
    at the end: published twice, the second time in the place of the first."""
    out, chk, still = (scratch_path(spark, f"open-{x}") for x in ("out", "chk", "views"))
    query = start_views_per_state(lines_stream(spark, sf_dir), zip_states(spark, sf_dir), out, chk, partition_by=None, trigger="availableNow")
    query.awaitTermination()
    for _ in range(2):
        publish_open_views(spark, chk, still)
    delete_path(spark, chk)
    return read_views_with_open(spark, out, still)


def skewed_clicks(lines: DataFrame) -> DataFrame:
    """Clicks whose even zip codes are all one: it has about half of the clicks."""
    clicks = click_times(lines)
    return clicks.withColumn("zip_code", F.when(F.col("zip_code") % 2 == 0, F.lit(HOT_ZIP)).otherwise(F.col("zip_code")))


def q_clicks_with_state_skewed(spark, sf_dir):
    """The stream's zip join with a hot zip code, found by sketches of two recordings."""
    out, chk = scratch_path(spark, "skew-out"), scratch_path(spark, "skew-chk")
    recorded = skewed_clicks(lines(spark, sf_dir))
    halves = [key_sketch(recorded.filter(F.pmod(F.xxhash64("date_time"), F.lit(2)) == k), "zip_code") for k in (0, 1)]
    hot = hot_keys(merge_sketches(halves[0].union(halves[1])))
    joined = with_state(skewed_clicks(lines_stream(spark, sf_dir)), zip_states(spark, sf_dir), hot=hot)
    start_file_sink(joined, out, chk, trigger="availableNow").awaitTermination()
    delete_path(spark, chk)
    return spark.read.schema(joined.schema).parquet(out)


def q_hour_slice(spark, sf_dir):
    return hour_slice_stored(day_store(spark, sf_dir), REPORT_DATE)


def q_product_totals_day(spark, sf_dir):
    return product_totals(hour_slice_stored(day_store(spark, sf_dir), REPORT_DATE))


def featured_query(spark, sf_dir, date, order, full=True):
    return featured_from_clicks(
        clicks_with_state(spark, sf_dir),
        date,
        products(spark, sf_dir),
        order=order,
        categories=categories(spark, sf_dir) if full else None,
        departments=departments(spark, sf_dir) if full else None,
    )


def q_featured_top(spark, sf_dir):
    return featured_query(spark, sf_dir, REPORT_DATE, "top")


def q_featured_low(spark, sf_dir):
    return featured_query(spark, sf_dir, REPORT_DATE, "low")


def q_featured_products_only(spark, sf_dir):
    return featured_query(spark, sf_dir, REPORT_DATE, "top", full=False)


def q_featured_from_store(spark, sf_dir):
    """The whole views table stored by hour, then one day's report from it."""
    store = scratch_path(spark, "views-store")
    write_views(views(spark, sf_dir), store)
    return featured_from_store(
        read_views(spark, store),
        REPORT_DATE,
        products(spark, sf_dir),
        categories=categories(spark, sf_dir),
        departments=departments(spark, sf_dir),
    )


def q_featured_day_anchor(spark, sf_dir):
    """Every day's report with the closing minute taken over the whole day."""
    return featured_all_days(
        clicks_with_state(spark, sf_dir), products(spark, sf_dir), anchor="day"
    )


def q_featured_all_days(spark, sf_dir):
    return featured_all_days(
        clicks_with_state(spark, sf_dir, far=True),
        products(spark, sf_dir),
        categories=categories(spark, sf_dir),
        departments=departments(spark, sf_dir),
    )


def _grid_span() -> tuple[str, str]:
    start = dt.datetime.fromisoformat(GRID_START)
    first = start + dt.timedelta(seconds=GRID_STEP_S)
    last = start + dt.timedelta(seconds=GRID_STEP_S * (GRID_STEPS + 1))
    return first.isoformat(sep=" "), last.isoformat(sep=" ")


def q_view_grid(spark, sf_dir):
    # Every (product, state) seen in any window is a pair seen in a click.
    keys = clicks_with_state(spark, sf_dir).select("product_id", "state").distinct()
    return view_grid(keys, GRID_START, GRID_STEPS, GRID_STEP_S)


def _grid_input(spark, sf_dir):
    """Series keys and the views of the grid's span, from pane counts that are
    stored once."""
    scratch_root(spark)
    panes = pane_counts(clicks_with_state(spark, sf_dir)).checkpoint(eager=True)
    keys = panes.select("product_id", "state").distinct()
    first, last = _grid_span()
    hi = dt.datetime.fromisoformat(last) + dt.timedelta(seconds=DEFAULT_WINDOW.size_s)
    span = panes.filter(
        (F.col("pane") >= F.lit(first).cast("timestamp"))
        & (F.col("pane") < F.lit(hi.isoformat(sep=" ")).cast("timestamp"))
    )
    return keys, views_from_panes(span)


def q_fill_views(spark, sf_dir):
    keys, span_views = _grid_input(spark, sf_dir)
    return gap_filled_views(span_views, GRID_START, GRID_STEPS, GRID_STEP_S, keys=keys)


def q_fill_views_positive(spark, sf_dir):
    """The grid job as it runs: rows with a count, written by hour in one job
    and read back."""
    out = scratch_path(spark, "grid")
    keys, span_views = _grid_input(spark, sf_dir)
    backfill_grid(span_views, out, GRID_START, GRID_STEPS, GRID_STEP_S, keys=keys)
    return read_views(spark, out)


def q_backfill_rerun(spark, sf_dir):
    """The grid job run twice under one name, beside the rest of the day under
    another: the second run replaces the first, so every row is there once."""
    out = scratch_path(spark, "grid-rerun")
    keys, span_views = _grid_input(spark, sf_dir)
    half = GRID_STEPS // 2
    later = (dt.datetime.fromisoformat(GRID_START) + dt.timedelta(seconds=GRID_STEP_S * (half + 1))).isoformat(sep=" ")
    for run, start, steps in (("am", GRID_START, half), ("pm", later, GRID_STEPS - half - 1), ("am", GRID_START, half)):
        backfill_grid(span_views, out, start, steps, GRID_STEP_S, keys=keys, run=run)
    return read_views(spark, out)


def q_grid_series(spark, sf_dir):
    """Series of all products and known states, as the grid job's own key table."""
    states = distinct_states(zip_states(spark, sf_dir)).where("state IS NOT NULL")
    return series_of(products(spark, sf_dir), states)


def q_record_roundtrip(spark, sf_dir):
    out, chk = scratch_path(spark, "record-out"), scratch_path(spark, "record-chk")
    query = record_clicks(lines_stream(spark, sf_dir), out, chk, trigger="availableNow")
    query.awaitTermination()
    delete_path(spark, chk)
    return read_store(spark, out, CLICK_RECORD, "zip_code").select(*CLICK_RECORD.fieldNames())


def q_csv_stream_roundtrip(spark, sf_dir):
    """The test mode's stream (short windows, generated zip codes) as
    ``|``-separated CSV by hour, read back."""
    out, chk = scratch_path(spark, "csv-out"), scratch_path(spark, "csv-chk")
    query = start_views_per_state(
        lines_stream(spark, sf_dir),
        dev_zip_states(spark),
        out,
        chk,
        window=DEV_WINDOW,
        fmt="csv",
        trigger="availableNow",
    )
    query.awaitTermination()
    delete_path(spark, chk)
    return spark.read.schema(PRODUCT_VIEWS).option("sep", "|").csv(out)


def q_fan_out_roundtrip(spark, sf_dir):
    """One stream, two sinks: the clicks and their number per product."""
    clicks_out, counts_out = scratch_path(spark, "fan-clicks"), scratch_path(spark, "fan-counts")
    chk, log = scratch_path(spark, "fan-chk"), scratch_path(spark, "fan-log")
    clicks = with_state(click_times(lines_stream(spark, sf_dir)), zip_states(spark, sf_dir))
    per_product = lambda batch: batch.groupBy("product_id").count()
    sinks = [epoch_sink(clicks_out), epoch_sink(counts_out, build=per_product)]
    start_fan_out(clicks, sinks, chk, trigger="availableNow", commit_to=log).awaitTermination()
    delete_path(spark, chk)
    raw = read_epochs(spark, clicks_out, clicks.schema, commit_to=log)
    counts = read_epochs(spark, counts_out, "product_id bigint, count bigint", commit_to=log)
    left = raw.groupBy("product_id", "state").agg(F.count("*").alias("clicks"))
    right = counts.groupBy(F.col("product_id").alias("_p")).agg(F.sum("count").alias("product_clicks"))
    return left.join(right, F.col("product_id").eqNullSafe(F.col("_p"))).drop("_p")


def q_states_from_csv(spark, sf_dir):
    """Distinct states of a zip-code CSV file with header."""
    out = scratch_path(spark, "zips-csv")
    rows = zip_states(spark, sf_dir)
    rows.select(
        F.coalesce("zip_code", F.lit(0)).alias("id"), "zip_code", F.lit("a, b").alias("city"), F.lit('"c"').alias("county"), "state"
    ).write.option("header", True).csv(out)
    return distinct_states(read_zip_states(spark, out, "csv"))


def q_report_roundtrip(spark, sf_dir):
    """Every day's report as written: the rows of each day's file with their
    place in it. One day is written again by itself."""
    out = scratch_path(spark, "report")
    clicks, prods = clicks_with_state(spark, sf_dir), products(spark, sf_dir)
    cats, deps = categories(spark, sf_dir), departments(spark, sf_dir)
    write_report(featured_all_days(clicks, prods, categories=cats, departments=deps), out)
    write_report(featured_query(spark, sf_dir, REPORT_DATE, "top"), out, date=REPORT_DATE)
    # A day is one file, read in one task in order.
    order = Window.partitionBy("date").orderBy(F.monotonically_increasing_id())
    return read_report(spark, out).withColumn("position", F.row_number().over(order))


def q_json_dims(spark, sf_dir):
    base = scratch_path(spark, "dims")
    for name, df in (
        ("products", products(spark, sf_dir)),
        ("categories", categories(spark, sf_dir)),
        ("departments", departments(spark, sf_dir)),
    ):
        df.write.json(f"{base}/{name}")
    p = read_products(spark, f"{base}/products")
    c = read_categories(spark, f"{base}/categories")
    d = read_departments(spark, f"{base}/departments")
    return p.join(c, F.col("category_id") == F.col("product_category_id")).join(
        d, F.col("department_id") == F.col("category_department_id")
    )


def q_stable_buckets(spark, sf_dir):
    return bucket_totals(product_views(clicks_with_state(spark, sf_dir, far=True)), PRODUCT_BUCKETS)


def q_sql_views(spark, sf_dir):
    from clickpanes.plans.sql import views_sql

    return views_sql(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_clicks": q_parse_clicks,
    "parse_click_times": q_parse_click_times,
    "zip_states": q_zip_states,
    "clicks_with_state": q_clicks_with_state,
    "product_views_sliding": q_product_views_sliding,
    "product_views_by_window": q_product_views_by_window,
    "product_views_dev": q_product_views_dev,
    "sql_views": q_sql_views,
    "product_views_stream": q_product_views_stream,
    "product_views_stream_late": q_product_views_stream_late,
    "views_stream_by_hour": q_views_stream_by_hour,
    "views_compacted": q_views_compacted,
    "views_stream_with_open": q_views_stream_with_open,
    "clicks_with_state_skewed": q_clicks_with_state_skewed,
    "csv_stream_roundtrip": q_csv_stream_roundtrip,
    "fan_out_roundtrip": q_fan_out_roundtrip,
    "hour_slice": q_hour_slice,
    "product_totals_day": q_product_totals_day,
    "featured_top": q_featured_top,
    "featured_low": q_featured_low,
    "featured_products_only": q_featured_products_only,
    "featured_all_days": q_featured_all_days,
    "featured_day_anchor": q_featured_day_anchor,
    "featured_from_store": q_featured_from_store,
    "view_grid": q_view_grid,
    "fill_views": q_fill_views,
    "fill_views_positive": q_fill_views_positive,
    "backfill_rerun": q_backfill_rerun,
    "grid_series": q_grid_series,
    "states_from_csv": q_states_from_csv,
    "stable_buckets": q_stable_buckets,
    "record_roundtrip": q_record_roundtrip,
    "report_roundtrip": q_report_roundtrip,
    "json_dims": q_json_dims,
}
