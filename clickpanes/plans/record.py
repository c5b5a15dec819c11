"""Record job: click lines from a stream -> Parquet partitioned by zip code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from clickpanes.operators.parse import click_records
from clickpanes.streaming.sinks import start_file_sink, start_store_sink


def record_clicks(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = "1 minute",
    partition_by: str = "zip_code",
    fmt: str = "parquet",
) -> StreamingQuery:
    """Parse every line (rows with a bad time are kept; the time stays
    text) and append it under ``partition_by`` folders. Parquet goes to a store with a commit log, one file per
    zip code and micro-batch (see ``start_store_sink``); other formats through Spark's file sink.
    """
    if fmt == "parquet" and partition_by:
        order = ["offset"] if "offset" in lines.columns else []
        return start_store_sink(click_records(lines), path, checkpoint, partition_by, order, trigger)
    return start_file_sink(
        click_records(lines),
        path,
        checkpoint,
        fmt=fmt,
        partition_by=partition_by,
        trigger=trigger,
        query_name=None,
        spread=["offset"] if "offset" in lines.columns else ["customer_id", "date_time"],
    )
