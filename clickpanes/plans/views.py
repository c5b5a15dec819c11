"""Views job: click lines + zip -> state table -> product views per state
per sliding window, for batch input or as a streaming query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickpanes.config import DEFAULT_WINDOW, ViewWindow
from clickpanes.operators.dims import with_state
from clickpanes.operators.parse import click_times
from clickpanes.operators.views import product_views
from clickpanes.sinks import VIEW_ORDER, write_views
from clickpanes.sources.files import read_views
from clickpanes.streaming.sinks import start_file_sink, start_store_sink
from clickpanes.streaming.views import open_views, windowed_views

# Fixed value: name of the streaming views query.
QUERY_NAME = "product_views_per_state_per_hour"


def views_per_state(
    lines: DataFrame, zip_states: DataFrame, window: ViewWindow = DEFAULT_WINDOW
) -> DataFrame:
    """Batch: every window with at least one click, fully counted."""
    return product_views(with_state(click_times(lines), zip_states), window)


def views_per_state_stream(
    lines: DataFrame, zip_states: DataFrame, window: ViewWindow = DEFAULT_WINDOW, hot: DataFrame | None = None
) -> DataFrame:
    """Streaming: windows are emitted once the watermark passes their end. ``hot``: zip codes
    to be salted in the join (see ``with_state``)."""
    return windowed_views(with_state(click_times(lines), zip_states, hot=hot), window)


def start_views_per_state(
    lines: DataFrame,
    zip_states: DataFrame,
    path: str,
    checkpoint: str,
    window: ViewWindow = DEFAULT_WINDOW,
    fmt: str = "parquet",
    partition_by: str | None = "hour",
    trigger: str | None = None,
    query_name: str = QUERY_NAME,
    hot: DataFrame | None = None,
) -> StreamingQuery:
    """Start the views query writing ``fmt`` files (``csv`` is written with
    ``|`` as separator, as the test mode does).

    The rows come out of the stateful aggregation spread by (window,
    product, state). Parquet by hour goes to a store with a commit log, one file per hour
    and micro-batch, in the order of ``write_views`` (see ``start_store_sink``); other forms go through Spark's file sink."""
    views = views_per_state_stream(lines, zip_states, window, hot)
    if fmt == "parquet" and partition_by:
        return start_store_sink(views, path, checkpoint, partition_by, VIEW_ORDER, trigger, query_name)
    options = {"sep": "|"} if fmt == "csv" else None
    return start_file_sink(
        views,
        path,
        checkpoint,
        fmt=fmt,
        partition_by=partition_by,
        trigger=trigger,
        query_name=query_name,
        options=options,
        spread=["product_id"],
    )


def publish_open_views(spark: SparkSession, checkpoint: str, path: str) -> None:
    """Publish the counts of the windows that are still open as provisional views under ``path``, in the place of
    those published before (``read_views_with_open`` reads both)."""
    write_views(open_views(spark, checkpoint), path, run="open")


def read_views_with_open(spark: SparkSession, path: str, open_path: str) -> DataFrame:
    """The emitted views and, of the provisional ones, those of windows that have not been emitted since;
    column ``provisional`` tells them apart.

    Windows close in the order of their start, so a provisional window counts where it starts after every emitted one: a
    one-row aggregate, no join on the keys."""
    final = read_views(spark, path)
    last = final.agg(F.max("period_start").alias("_last"))
    still = read_views(spark, open_path).join(F.broadcast(last), F.col("_last").isNull() | (F.col("period_start") > F.col("_last")))
    return final.withColumn("provisional", F.lit(False)).unionByName(still.drop("_last").withColumn("provisional", F.lit(True)))
