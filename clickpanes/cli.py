"""Command line for the four jobs (``python -m clickpanes <job> ...``),
for ``spark-submit``; the session comes from the cluster's configuration.

    record    lines (Kafka topic or text folder) -> Parquet by zip code
    views     lines + zip->state table -> views per state per window
    featured  stored views -> the day's top/low products report (CSV)
    grid      stored views -> gap-filled views over a span (Parquet by hour)
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from clickpanes.config import DEFAULT_WINDOW, DEV_WINDOW, FEATURED_N, ViewWindow
from clickpanes.functions.timekeys import grid_start
from clickpanes.operators.featured import featured_products_daily
from clickpanes.operators.dims import distinct_states, with_state
from clickpanes.operators.grid import series_of
from clickpanes.operators.parse import click_times
from clickpanes.plans.featured import featured_report, run_featured
from clickpanes.plans.grid import backfill_grid
from clickpanes.plans.record import record_clicks
from clickpanes.plans.views import start_views_per_state
from clickpanes.sinks import write_report
from clickpanes.sources.files import (
    dev_zip_states,
    read_categories,
    read_departments,
    read_products,
    read_views,
    read_zip_states,
    text_lines_stream,
)
from clickpanes.sources.kafka import DEFAULT_SERVERS, DEFAULT_TOPIC, kafka_lines
from clickpanes.streaming.sinks import start_console
from clickpanes.streaming.views import windowed_views

# Names of the test mode's console queries.
CONSOLE_VIEWS_NAME = "console_product_views_per_state_per_hour"
CONSOLE_CLICKS_NAME = "product_stream_original"


def _lines(spark: SparkSession, args) -> DataFrame:
    if args.text_dir:
        return text_lines_stream(spark, args.text_dir, args.max_files)
    return kafka_lines(spark, args.kafka_servers, args.topic, with_offset=True)


def _stream_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--out", required=True, help="output folder")
    p.add_argument("--checkpoint", required=True, help="checkpoint folder (shared file system)")
    p.add_argument("--kafka-servers", default=DEFAULT_SERVERS)
    p.add_argument("--topic", default=DEFAULT_TOPIC)
    p.add_argument("--text-dir", help="read lines from text files here instead of Kafka")
    p.add_argument("--max-files", type=int, help="files per micro-batch (text source)")
    p.add_argument("--trigger", help="processing-time interval, 'availableNow' or 'once'")
    p.add_argument("--no-wait", action="store_true", help="start and return")


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="clickpanes", description=__doc__.split("\n")[0])
    sub = ap.add_subparsers(dest="job", required=True)

    rec = sub.add_parser("record", help="record clicks as Parquet partitioned by zip code")
    _stream_args(rec)
    rec.set_defaults(trigger_default="1 minute")

    views = sub.add_parser("views", help="product views per state per window")
    _stream_args(views)
    views.add_argument("--zip-states", help="zip->state table (Parquet or CSV)")
    views.add_argument("--zip-format", choices=["parquet", "csv"], default="parquet")
    views.add_argument("--dev", action="store_true", help="5 min windows sliding 1 min, generated zips, CSV out")
    views.add_argument("--window", default=DEFAULT_WINDOW.size)
    views.add_argument("--slide", default=DEFAULT_WINDOW.slide)
    views.add_argument("--format", choices=["parquet", "csv"], default=None)
    views.add_argument("--console", action="store_true", help="also print window counts and parsed clicks (test mode)")
    views.set_defaults(trigger_default=None)

    feat = sub.add_parser("featured", help="the day's most or least viewed products")
    feat.add_argument("--views", required=True, help="stored product views (Parquet by hour)")
    feat.add_argument("--date", help="yyyy-mm-dd")
    feat.add_argument("--all-days", action="store_true", help="a report for every day in the views")
    feat.add_argument("--out", required=True, help="report folder (CSV by year/month/day)")
    feat.add_argument("--products", required=True)
    feat.add_argument("--categories")
    feat.add_argument("--departments")
    feat.add_argument("--order", choices=["top", "low"], default="top")
    feat.add_argument("-n", type=int, default=FEATURED_N)
    feat.add_argument("--anchor", choices=["hour00", "day"], default="hour00")

    grid = sub.add_parser("grid", help="gap-filled views over a span of stamps")
    grid.add_argument("--views", required=True)
    grid.add_argument("--out", required=True)
    grid.add_argument("--steps", type=int, default=2, help="number of intervals (steps + 1 stamps)")
    grid.add_argument("--step-seconds", type=int, default=300)
    grid.add_argument("--start", help="'yyyy-mm-dd HH:MM:SS'; default: steps intervals before now")
    grid.add_argument("--start-delta-seconds", type=int, default=-1)
    grid.add_argument("--products", help="products (JSON) whose series to fill; with --states, instead of the series in the views")
    grid.add_argument("--states", help="states table (CSV with header or Parquet)")
    grid.add_argument("--states-format", choices=["csv", "parquet"], default="csv")
    grid.add_argument("--all-rows", action="store_true", help="keep zero counts too")
    return ap


def run(argv: Sequence[str] | None = None, spark: SparkSession | None = None):
    """Run one job; streaming jobs return their ``StreamingQuery``."""
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    if args.job in ("record", "views"):
        trigger = args.trigger or args.trigger_default
        if args.job == "record":
            query = record_clicks(_lines(spark, args), args.out, args.checkpoint, trigger=trigger)
        else:
            if args.dev:
                window, zips, fmt = DEV_WINDOW, dev_zip_states(spark), args.format or "csv"
            else:
                if not args.zip_states:
                    raise SystemExit("--zip-states is required (or --dev)")
                window = ViewWindow(args.window, args.slide)
                zips = read_zip_states(spark, args.zip_states, args.zip_format)
                fmt = args.format or "parquet"
            lines = _lines(spark, args)
            query = start_views_per_state(
                lines, zips, args.out, args.checkpoint, window=window, fmt=fmt, trigger=trigger
            )
            if args.console:
                clicks = click_times(lines)
                extra = [
                    start_console(
                        windowed_views(with_state(clicks, zips), window),
                        CONSOLE_VIEWS_NAME,
                        trigger,
                    ),
                    start_console(clicks, CONSOLE_CLICKS_NAME, trigger),
                ]
                if not args.no_wait:
                    for q in extra:
                        q.awaitTermination()
        if not args.no_wait:
            query.awaitTermination()
        return query
    if args.job == "featured":
        if args.all_days == bool(args.date):
            raise SystemExit("give either --date or --all-days")
        if args.all_days:
            report = featured_products_daily(
                read_views(spark, args.views),
                read_products(spark, args.products),
                order=args.order,
                n=args.n,
                categories=read_categories(spark, args.categories) if args.categories else None,
                departments=read_departments(spark, args.departments) if args.departments else None,
                anchor=args.anchor,
            )
            write_report(report, args.out, args.order)
            return report
        report = featured_report(
            read_views(spark, args.views),
            args.date,
            read_products(spark, args.products),
            order=args.order,
            n=args.n,
            categories=read_categories(spark, args.categories) if args.categories else None,
            departments=read_departments(spark, args.departments) if args.departments else None,
            anchor=args.anchor,
        )
        run_featured(report, args.out, args.order, args.date)
        return report
    start = args.start or grid_start(
        dt.datetime.now(), args.steps, args.step_seconds, args.start_delta_seconds
    ).isoformat(sep=" ")
    if bool(args.products) != bool(args.states):
        raise SystemExit("give --products and --states together")
    keys = None
    if args.products:
        states = distinct_states(read_zip_states(spark, args.states, args.states_format))
        keys = series_of(read_products(spark, args.products), states)
    backfill_grid(
        read_views(spark, args.views), args.out, start, args.steps, args.step_seconds,
        keys=keys, positive_only=not args.all_rows,
    )
    return None
