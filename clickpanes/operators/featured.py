"""Featured products of a day: most (or least) viewed products, enriched.

The views hold overlapping windows (1 h long, one every 5 min); to count
each click once per hour the day is cut into the windows that start at
one fixed minute of every hour, the *closing minute*: the largest minute
among the windows of the day's first hour. With 5-minute slides that is
minute 55, so the slice covers 00:55 of the day to 00:55 of the next.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpanes.config import FEATURED_N, ViewWindow
from clickpanes.functions.timekeys import hour_key
from clickpanes.schemas import REPORT

_DATE = re.compile(r"^\d{4}-\d{2}-\d{2}$")
_ORDERS = {"top": "desc", "low": "asc", "desc": "desc", "asc": "asc"}


def day_number(date: str) -> int:
    """``'2024-01-15'`` -> 20240115, after checking it is a real date."""
    if not isinstance(date, str) or not _DATE.match(date):
        raise ValueError(f"date must be yyyy-mm-dd, got {date!r}")
    _dt.date.fromisoformat(date)
    return int(date.replace("-", ""))


def day_hours(date: str) -> tuple[int, int]:
    d = day_number(date) * 100
    return d, d + 23


def closing_minute(views: DataFrame, date: str, anchor: str = "hour00") -> DataFrame:
    """One row, ``closing_minute``: the largest window-start minute in the
    first hour of the day (``anchor='hour00'``, as the production job) or
    over the whole day (``anchor='day'``). NULL when there are no windows
    there, in which case the slice, and so the report, is empty.

    A global aggregate has exactly one row, so joining it in is a broadcast
    of one row, planned with the main query (no scalar subquery and no
    driver round trip). Pass stored or checkpointed views so both uses
    read them instead of computing them twice.
    """
    first, last = day_hours(date)
    if anchor == "hour00":
        scope = views.filter(F.col("hour") == first)
    elif anchor == "day":
        scope = views.filter(F.col("hour").between(first, last))
    else:
        raise ValueError(f"anchor must be 'hour00' or 'day', got {anchor!r}")
    return scope.agg(F.max(F.minute("period_start")).alias("closing_minute"))


def _at_closing_minute(df: DataFrame, minute: Column, views: DataFrame, date: str, anchor: str) -> DataFrame:
    mm = F.broadcast(closing_minute(views, date, anchor))
    return df.join(mm, minute == F.col("closing_minute")).drop("closing_minute")


def hour_slice(views: DataFrame, date: str, anchor: str = "hour00") -> DataFrame:
    """Views of the day's windows that start at the closing minute.

    The predicates on ``hour`` prune partition directories when the views
    are read from their hour-partitioned store.
    """
    first, last = day_hours(date)
    day = views.filter(F.col("hour").between(first, last))
    return _at_closing_minute(day, F.minute("period_start"), views, date, anchor)


def closing_starts(views: DataFrame, date: str, anchor: str = "hour00") -> list[int]:
    """The window starts of the day's slice, as epoch microseconds of the minutes they lie in: every minute
    of the day whose number is the closing minute (24 of them, or 23 to 25 where clocks
    change); none where the closing minute is NULL.

    This runs a one-row job: from a store it reads the first hour's folder (with ``anchor='day'``
    the day's), one column."""
    first, last = day_hours(date)
    begin = F.lit(f"{date} 00:00:00").cast("timestamp")
    minutes = F.sequence(begin, begin + F.expr("INTERVAL 25 HOURS"), F.expr("INTERVAL 1 MINUTE"))
    at = F.filter(minutes, lambda t: (F.minute(t) == F.col("closing_minute")) & hour_key(t).between(first, last))
    row = closing_minute(views, date, anchor).select(F.transform(at, F.unix_micros).alias("at")).first()
    return row["at"] or []


def hour_slice_stored(views: DataFrame, date: str, anchor: str = "hour00") -> DataFrame:
    """``hour_slice`` of stored views, reading little more than the slice.

    The slice is stated as 24 ranges of ``period_start`` (one minute each) beside the hours, so
    the ranges are pushed into the Parquet scan, and in files that ``write_views``
    has ordered by window the pages of the other windows (11 of 12) are skipped."""
    first, last = day_hours(date)
    day = views.filter(F.col("hour").between(first, last))
    wanted = F.lit(False)
    for us in closing_starts(views, date, anchor):
        begin, end = F.timestamp_micros(F.lit(us)), F.timestamp_micros(F.lit(us + 60_000_000))
        wanted = wanted | ((F.col("period_start") >= begin) & (F.col("period_start") < end))
    return day.filter(wanted)


def product_totals(views_slice: DataFrame) -> DataFrame:
    """``product_id, no_views``: views summed per product."""
    return views_slice.groupBy("product_id").agg(
        F.sum("count").cast("bigint").alias("no_views")
    )


def day_totals(views: DataFrame, date: str, anchor: str = "hour00") -> DataFrame:
    """``product_id, no_views`` over the day's slice. Equal to
    ``product_totals(hour_slice(...))``, but the views are aggregated before
    the slice is chosen (see ``daily_totals``)."""
    first, last = day_hours(date)
    day = views.filter(F.col("hour").between(first, last))
    return daily_totals(day, anchor).select("product_id", "no_views")


def _direction(order: str) -> str:
    try:
        return _ORDERS[order]
    except KeyError:
        raise ValueError(f"order must be one of {sorted(_ORDERS)}, got {order!r}") from None


def _ranking(order: str) -> list[Column]:
    views = F.col("no_views").desc() if _direction(order) == "desc" else F.col("no_views").asc()
    return [views, F.col("product_id").asc()]


def top_products(totals: DataFrame, order: str = "top", n: int = FEATURED_N) -> DataFrame:
    """The ``n`` most (``top``) or least (``low``) viewed products; ties go
    to the smaller product id. Planned as a per-partition top-n merged in
    one task (never a full sort)."""
    if n < 1:
        raise ValueError(f"n must be at least 1, got {n}")
    return totals.orderBy(*_ranking(order)).limit(n)


def enrich(
    top: DataFrame,
    products: DataFrame,
    categories: DataFrame | None = None,
    departments: DataFrame | None = None,
) -> DataFrame:
    """Inner joins with products, then categories, then departments.

    ``top`` comes from a limit, so Spark knows its size and broadcasts it where
    ``n`` rows are below its threshold; the product table is then scanned once and
    not shuffled. Products missing from a dimension drop out (inner joins).
    """
    out = top.join(products, "product_id")
    if categories is not None:
        out = out.join(categories, F.col("category_id") == F.col("product_category_id"))
        if departments is not None:
            out = out.join(
                departments, F.col("department_id") == F.col("category_department_id")
            )
    return out


def _report_columns(
    date_cols: list[Column], with_categories: bool, with_departments: bool
) -> list[Column]:
    types = {f.name: f.dataType for f in REPORT.fields}

    def absent(name: str) -> Column:
        return F.lit(None).cast(types[name]).alias(name)

    with_departments = with_categories and with_departments
    return [
        F.col("product_id").cast("bigint").alias("product_id"),
        F.col("no_views"),
        F.col("product_category_id").alias("category_id"),
        F.col("department_id") if with_departments else absent("department_id"),
        F.col("product_name"),
        F.col("product_description"),
        F.col("product_image"),
        F.col("product_price"),
        F.col("category_name") if with_categories else absent("category_name"),
        F.col("department_name") if with_departments else absent("department_name"),
        *date_cols,
    ]


def report_layout(
    enriched: DataFrame,
    date: str,
    order: str = "top",
    with_categories: bool = False,
    with_departments: bool = False,
) -> DataFrame:
    """Fixed report columns; enrichments that were not given are typed NULLs."""
    day_number(date)
    year, month, day = (int(p) for p in date.split("-"))
    dates = [
        F.lit(date).alias("date"),
        F.lit(day).alias("day"),
        F.lit(month).alias("month"),
        F.lit(year).alias("year"),
    ]
    cols = _report_columns(dates, with_categories, with_departments)
    return enriched.select(*cols).orderBy(*_ranking(order))


def featured_products(
    views: DataFrame,
    date: str,
    products: DataFrame,
    order: str = "top",
    n: int = FEATURED_N,
    categories: DataFrame | None = None,
    departments: DataFrame | None = None,
    anchor: str = "hour00",
) -> DataFrame:
    """Report of the day's ``n`` most or least viewed products."""
    top = top_products(day_totals(views, date, anchor), order, n)
    enriched = enrich(top, products, categories, departments)
    return report_layout(
        enriched,
        date,
        order,
        with_categories=categories is not None,
        with_departments=departments is not None,
    )


def featured_from_store(
    views: DataFrame,
    date: str,
    products: DataFrame,
    order: str = "top",
    n: int = FEATURED_N,
    categories: DataFrame | None = None,
    departments: DataFrame | None = None,
    anchor: str = "hour00",
) -> DataFrame:
    """``featured_products`` of stored views (see ``hour_slice_stored``)."""
    top = top_products(product_totals(hour_slice_stored(views, date, anchor)), order, n)
    enriched = enrich(top, products, categories, departments)
    return report_layout(enriched, date, order, with_categories=categories is not None, with_departments=departments is not None)


# --- every day at once ---------------------------------------------------


def _day_key(hour: Column | None = None) -> Column:
    hour = F.col("hour") if hour is None else hour
    return F.floor(hour / 100).cast("int")


def _closing_minutes(starts: DataFrame, anchor: str) -> DataFrame:
    """``closing_day, closing_minute`` of window starts (``period_start, hour``).

    One row per calendar day, so at most 3.7 million rows for the years 1 to
    9999: a broadcast of bounded size, which spares the counts a shuffle
    by day (a busy day would load a few tasks)."""
    if anchor == "hour00":
        starts = starts.filter(F.col("hour") % 100 == 0)
    elif anchor != "day":
        raise ValueError(f"anchor must be 'hour00' or 'day', got {anchor!r}")
    return F.broadcast(
        starts.groupBy(_day_key().alias("closing_day")).agg(
            F.max(F.minute("period_start")).alias("closing_minute")
        )
    )


def daily_totals(views: DataFrame, anchor: str = "hour00") -> DataFrame:
    """``day_key (yyyymmdd), product_id, no_views`` for the slice of every
    day in the views: one aggregation per (day, product, window minute),
    then each day's closing-minute sums are kept."""
    per_minute = views.groupBy(
        _day_key().alias("day_key"), "product_id", F.minute("period_start").alias("minute")
    ).agg(F.sum("count").cast("bigint").alias("no_views"))
    closing = _closing_minutes(views.select("period_start", "hour"), anchor)
    kept = per_minute.join(
        closing,
        (F.col("day_key") == F.col("closing_day")) & (F.col("minute") == F.col("closing_minute")),
    )
    return kept.select("day_key", "product_id", "no_views")


def daily_totals_from_panes(panes: DataFrame, window: ViewWindow, anchor: str = "hour00") -> DataFrame:
    """``daily_totals`` straight from pane counts (``product_id, state,
    pane, n``), never building the view table.

    Which windows exist follows from the distinct panes alone (one row per
    pane of time), so only these are expanded to find the closing minutes.
    A pane then goes straight to the windows that start at the closing minute
    of an hour and cover it: for a window of one hour, one of the two hours
    before the pane's end, instead of all ``size / slide`` windows.
    """
    spans = panes.select("pane").distinct()
    spans = spans.select(F.window("pane", window.size, window.slide).start.alias("period_start"))
    closing = _closing_minutes(spans.withColumn("hour", hour_key("period_start")), anchor)
    size = F.make_dt_interval(secs=F.lit(window.size_s))
    hours = F.sequence(
        F.date_trunc("hour", F.col("pane") - size), F.date_trunc("hour", "pane"), F.expr("INTERVAL 1 HOUR")
    )
    near = panes.select("product_id", "n", "pane", F.explode(hours).alias("_hour"))
    near = near.withColumn("day_key", _day_key(hour_key("_hour")))
    at = near.join(closing, F.col("day_key") == F.col("closing_day")).withColumn(
        "_start", F.col("_hour") + F.make_dt_interval(mins=F.col("closing_minute"))
    )
    slide_us = window.slide_s * 1_000_000
    kept = at.filter(
        (F.col("_start") <= F.col("pane"))
        & (F.col("_start") + size > F.col("pane"))
        & (F.pmod(F.unix_micros("_start"), F.lit(slide_us)) == 0)
    )
    return kept.groupBy("day_key", "product_id").agg(F.sum("n").cast("bigint").alias("no_views"))


def top_products_per_day(totals: DataFrame, order: str = "top", n: int = FEATURED_N) -> DataFrame:
    """The ``n`` most or least viewed products of each day.

    ``row_number() <= n`` over a window per day is planned with a window
    group limit: every task keeps only its own ``n`` best rows per day
    before the shuffle, so even a day holding most of the data sends at
    most ``n`` rows per task to its ranking task.
    """
    if n < 1:
        raise ValueError(f"n must be at least 1, got {n}")
    w = Window.partitionBy("day_key").orderBy(*_ranking(order))
    return (
        totals.withColumn("_rank", F.row_number().over(w))
        .filter(F.col("_rank") <= n)
        .drop("_rank")
    )


def daily_report_layout(
    enriched: DataFrame,
    order: str = "top",
    with_categories: bool = False,
    with_departments: bool = False,
) -> DataFrame:
    """Report columns for rows carrying their own ``day_key``."""
    key = F.col("day_key")
    dates = [
        F.date_format(F.to_date(key.cast("string"), "yyyyMMdd"), "yyyy-MM-dd").alias("date"),
        (key % 100).cast("int").alias("day"),
        (F.floor(key / 100) % 100).cast("int").alias("month"),
        F.floor(key / 10000).cast("int").alias("year"),
    ]
    cols = _report_columns(dates, with_categories, with_departments)
    return enriched.select(*cols).orderBy("year", "month", "day", *_ranking(order))


def enrich_daily(
    top: DataFrame,
    products: DataFrame,
    categories: DataFrame | None = None,
    departments: DataFrame | None = None,
    order: str = "top",
) -> DataFrame:
    """Enrichment and layout of per-day top rows (``day_key`` carried)."""
    out = top.join(products, "product_id")
    if categories is not None:
        out = out.join(categories, F.col("category_id") == F.col("product_category_id"))
        if departments is not None:
            out = out.join(departments, F.col("department_id") == F.col("category_department_id"))
    return daily_report_layout(
        out,
        order,
        with_categories=categories is not None,
        with_departments=departments is not None,
    )


def featured_products_daily(
    views: DataFrame,
    products: DataFrame,
    order: str = "top",
    n: int = FEATURED_N,
    categories: DataFrame | None = None,
    departments: DataFrame | None = None,
    anchor: str = "hour00",
) -> DataFrame:
    """``featured_products`` for every day of the views in one job.

    The ranked rows, at most ``n`` per day, are the small side of the
    enrichment joins; adaptive execution broadcasts them where their measured
    size allows it.
    """
    top = top_products_per_day(daily_totals(views, anchor), order, n)
    return enrich_daily(top, products, categories, departments, order)
