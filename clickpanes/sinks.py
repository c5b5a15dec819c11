"""Batch sinks: hour-partitioned views and the daily report CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpanes.store import PAGE_ROWS, by_value, publish, write_parquet

# Partition columns and CSV dialect of the report files.
REPORT_PARTITIONS = ["year", "month", "day"]
REPORT_CSV = {"sep": "|", "header": "true", "quote": '"', "escape": '"', "multiLine": "true"}


# Fixed value: within an hour, views lie in the order of their window.
VIEW_ORDER = ["period_start", "product_id"]


def write_views(views: DataFrame, path: str, mode: str = "append", run: str | None = None, page_rows: int = PAGE_ROWS) -> None:
    """Put views into a Parquet store partitioned by ``hour``.

    Adaptive execution cuts the rows into evenly sized write tasks by hour (small hours are merged, an hour
    with a large share of the rows is split). Within a file the rows are in the order of ``period_start``, in pages of
    ``page_rows`` rows, so a reader of a few windows skips the pages of the others.

    With ``run``, the write is that run of the store's commit log (see ``clickpanes.store``): readers see it once it is
    complete, and writing the run again replaces it. Without, the rows are added as they are.
    """
    rows = by_value(views, "hour", VIEW_ORDER)
    if run is not None:
        publish(rows, path, run, "hour", page_rows)
        return
    write_parquet(rows, path, "hour", mode, page_rows)


def write_report(report: DataFrame, path: str, order: str = "top", date: str | None = None) -> None:
    """One CSV file with header per day, in ``year=/month=/day=`` folders,
    its rows in the order of the report.

    With ``date`` that day's folder is replaced, by a file with the header
    alone if the report is empty. Without, every day in the report is
    replaced (dynamic partition overwrite) and other days stay; a day is one task,
    with at most ``n`` rows.
    """
    views = F.col("no_views").desc() if order in ("top", "desc") else F.col("no_views").asc()
    ranking = [views, F.col("product_id")]
    if date is not None:
        year, month, day = (int(p) for p in date.split("-"))
        folder = f"{path}/year={year}/month={month}/day={day}"
        out = report.drop(*REPORT_PARTITIONS).repartition(1).sortWithinPartitions(*ranking)
        out.write.mode("overwrite").options(**REPORT_CSV).csv(folder)
        return
    (
        report.repartition(*REPORT_PARTITIONS)
        .sortWithinPartitions(*REPORT_PARTITIONS, *ranking)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*REPORT_PARTITIONS)
        .options(**REPORT_CSV)
        .csv(path)
    )


def read_report(spark: SparkSession, path: str) -> DataFrame:
    from clickpanes.schemas import REPORT

    return spark.read.schema(REPORT).options(**REPORT_CSV).csv(path)
