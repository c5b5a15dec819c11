"""Product views per state in sliding event-time windows (batch form).

``product_views`` counts each click once into its pane (the span of
``gcd(size, slide)`` whose events share the same windows), then spreads the
pane counts to the windows that cover the pane. Compared with ``F.window``
on the clicks, which copies every click into ``size / slide`` rows before
aggregating, the raw rows pass through one hash aggregation instead of
twelve copies; only the far smaller pane counts are multiplied. Both aggregations group by
a time key, so a product or state holding a large share of the clicks is
still spread over many groups and partial (map-side) aggregation bounds
what any task receives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpanes.config import DEFAULT_WINDOW, ViewWindow
from clickpanes.functions.timekeys import hour_key, pane_seconds, pane_start

VIEW_COLUMNS = ["product_id", "state", "count", "period_start", "hour"]


def shape_views(counts: DataFrame, start: str = "period_start") -> DataFrame:
    """``product_id, state, count, period_start, hour`` from window counts."""
    return counts.select(
        "product_id",
        "state",
        F.col("count").cast("bigint").alias("count"),
        F.col(start).alias("period_start"),
        hour_key(F.col(start)).alias("hour"),
    )


def pane_counts(clicks: DataFrame, window: ViewWindow = DEFAULT_WINDOW) -> DataFrame:
    """Stage 1: ``product_id, state, pane (timestamp), n`` clicks per pane.

    Partial counts are combined map-side before the shuffle.
    """
    pane_s = pane_seconds(window.size_s, window.slide_s)
    return (
        clicks.select(
            "product_id",
            "state",
            F.timestamp_micros(pane_start("date_time", pane_s)).alias("pane"),
        )
        .groupBy("product_id", "state", "pane")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def views_from_panes(panes: DataFrame, window: ViewWindow = DEFAULT_WINDOW) -> DataFrame:
    """Stage 2: every pane count, stamped with the pane's start, goes to
    Spark's sliding ``window`` and is summed per window. A window covers the
    whole pane exactly when it covers the pane's start, because window
    bounds are multiples of the pane length."""
    counts = panes.groupBy(
        F.window("pane", window.size, window.slide).alias("w"), "product_id", "state"
    ).agg(F.sum("n").alias("count"))
    return shape_views(counts.withColumn("period_start", F.col("w.start")))


def product_views(clicks: DataFrame, window: ViewWindow = DEFAULT_WINDOW) -> DataFrame:
    """Count clicks per product, state and window (batch).

    Input ``product_id, state, date_time`` with non-NULL times. Output
    ``product_id bigint, state string, count bigint, period_start
    timestamp, hour int`` with one row per non-empty window.
    """
    return views_from_panes(pane_counts(clicks, window), window)


def views_by_window(clicks: DataFrame, window: ViewWindow = DEFAULT_WINDOW) -> DataFrame:
    """Same result through Spark's ``window`` grouping (the form a
    streaming aggregation needs); kept for comparison and for streams."""
    counts = clicks.groupBy(
        F.window("date_time", window.size, window.slide).alias("w"), "product_id", "state"
    ).count()
    return shape_views(counts.withColumn("period_start", F.col("w.start")))
