"""Featured products job: product views -> the day's report (-> CSV)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpanes.config import DEFAULT_WINDOW, FEATURED_N, ViewWindow
from clickpanes.operators.featured import (
    daily_totals_from_panes,
    day_number,
    enrich,
    enrich_daily,
    featured_products,
    report_layout,
    top_products,
    top_products_per_day,
)
from clickpanes.operators.views import pane_counts
from clickpanes.scratch import scratch_root
from clickpanes.sinks import write_report


def featured_report(
    views: DataFrame,
    date: str,
    products: DataFrame,
    order: str = "top",
    n: int = FEATURED_N,
    categories: DataFrame | None = None,
    departments: DataFrame | None = None,
    anchor: str = "hour00",
) -> DataFrame:
    """Report from stored (or computed) views; see ``featured_products``."""
    return featured_products(views, date, products, order, n, categories, departments, anchor)


def span_clicks(clicks: DataFrame, first: str, last: str, window: ViewWindow = DEFAULT_WINDOW) -> DataFrame:
    """Clicks that can reach a window starting in ``[first, last]``
    (timestamps as ``yyyy-mm-dd HH:MM:SS`` text): those in
    ``[first, last + size)``. Counting only these gives the exact counts
    of every window starting in the span."""
    lo = _dt.datetime.fromisoformat(first)
    hi = _dt.datetime.fromisoformat(last) + _dt.timedelta(seconds=window.size_s)
    fmt = "%Y-%m-%d %H:%M:%S"
    return clicks.filter(
        (F.col("date_time") >= F.lit(lo.strftime(fmt)).cast("timestamp"))
        & (F.col("date_time") < F.lit(hi.strftime(fmt)).cast("timestamp"))
    )


def day_clicks(clicks: DataFrame, date: str, window: ViewWindow = DEFAULT_WINDOW) -> DataFrame:
    """Clicks that can reach a window starting on ``date``: the windows
    start in ``[date, date + 1 day)`` and hold clicks up to one window
    length later, so nothing outside ``[date, date + 1 day + size)`` can
    change the report. Cutting here keeps the counting to one day."""
    day_number(date)
    lo = _dt.datetime.fromisoformat(date)
    last = lo + _dt.timedelta(days=1) - _dt.timedelta(microseconds=1)
    return span_clicks(clicks, lo.isoformat(sep=" "), last.isoformat(sep=" "), window)


def featured_from_clicks(
    clicks: DataFrame,
    date: str,
    products: DataFrame,
    order: str = "top",
    n: int = FEATURED_N,
    categories: DataFrame | None = None,
    departments: DataFrame | None = None,
    window: ViewWindow = DEFAULT_WINDOW,
    anchor: str = "hour00",
) -> DataFrame:
    """Report straight from clicks with state (no stored views): same
    result as counting all views first, but only the day's clicks are
    counted.

    The day's pane counts are stored once with a reliable checkpoint (a
    lost executor then costs a re-read, not a recount of the clicks); the
    closing minute and the totals both come from them, and only the
    windows at the closing minute are summed (``daily_totals_from_panes``).
    """
    day_key = day_number(date)
    if clicks.isStreaming:
        raise ValueError("featured_from_clicks needs batch clicks")
    scratch_root(clicks.sparkSession)
    panes = pane_counts(day_clicks(clicks, date, window), window).checkpoint(eager=True)
    totals = (
        daily_totals_from_panes(panes, window, anchor)
        .filter(F.col("day_key") == day_key)
        .select("product_id", "no_views")
    )
    top = top_products(totals, order, n)
    return report_layout(
        enrich(top, products, categories, departments),
        date,
        order,
        with_categories=categories is not None,
        with_departments=departments is not None,
    )


def run_featured(report: DataFrame, path: str, order: str = "top", date: str | None = None) -> None:
    write_report(report, path, order, date)


def featured_all_days(
    clicks: DataFrame,
    products: DataFrame,
    order: str = "top",
    n: int = FEATURED_N,
    categories: DataFrame | None = None,
    departments: DataFrame | None = None,
    window: ViewWindow = DEFAULT_WINDOW,
    anchor: str = "hour00",
) -> DataFrame:
    """Reports of every day (a backfill). Clicks are counted once into
    pane counts, stored with a reliable checkpoint; each day's slice is
    summed from them (``daily_totals_from_panes``, no full view table) and
    ranked per day; the ranked rows (at most ``n`` per day) are the small side
    of the enrichment joins."""
    if clicks.isStreaming:
        raise ValueError("featured_all_days needs batch clicks")
    scratch_root(clicks.sparkSession)
    panes = pane_counts(clicks, window).checkpoint(eager=True)
    totals = daily_totals_from_panes(panes, window, anchor)
    top = top_products_per_day(totals, order, n)
    return enrich_daily(top, products, categories, departments, order)
