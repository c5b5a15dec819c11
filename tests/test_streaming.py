"""Structured Streaming: watermark and late data, restart, sinks."""

import datetime as dt
import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from clickpanes.config import ViewWindow
from clickpanes.operators.dims import with_state
from clickpanes.operators.parse import click_times
from clickpanes.plans import catalog
from clickpanes.plans.record import record_clicks
from clickpanes.plans.views import start_views_per_state, views_per_state_stream
from clickpanes.schemas import CLICK_RECORD, PRODUCT_VIEWS
from clickpanes.sources.files import dev_zip_states, text_lines_stream
from clickpanes.sources.tables import event_lines, events_stream
from clickpanes.streaming.sinks import epoch_sink, read_epochs, start_fan_out
from conftest import SF_SMALL

TUMBLING = ViewWindow("1 hour", "1 hour")

# One file per micro-batch; times of day on 2024-01-01.
LATE_BATCHES = [["10:02"], ["12:07"], ["09:01", "10:31"], ["09:02", "12:20"], ["15:00"]]


def _local(path):
    return path.replace("file:", "")


def _write_batches(folder, batches, first=0):
    os.makedirs(folder, exist_ok=True)
    base = time.time() - 1000
    for i, times in enumerate(batches, start=first):
        f = os.path.join(folder, f"part-{i:03d}.txt")
        with open(f, "w") as fh:
            for t in times:
                fh.write(f"1|7|10001|1|1|2024/01/01 {t}:00\n")
        os.utime(f, (base + i * 10, base + i * 10))


def _run_views(spark, src, out, chk):
    q = start_views_per_state(
        text_lines_stream(spark, src, max_files=1), dev_zip_states(spark), out, chk,
        window=TUMBLING, partition_by="hour", trigger="availableNow",
    )
    q.awaitTermination()
    return q


def _counts(spark, out):
    df = spark.read.schema(PRODUCT_VIEWS).parquet(out)
    return sorted((r.period_start.hour, r["count"]) for r in df.collect())


def test_late_rows_follow_watermark(spark, scratch):
    src, out, chk = _local(scratch("late-src")), scratch("late-out"), scratch("late-chk")
    _write_batches(src, LATE_BATCHES)
    q = _run_views(spark, src, out, chk)
    assert _counts(spark, out) == [(9, 1), (10, 2), (12, 2)]
    wms = [p["eventTime"].get("watermark") for p in q.recentProgress]
    assert wms[1].startswith("2024-01-01T09:02") and wms[3].startswith("2024-01-01T11:07")


def test_restart_from_checkpoint_equals_one_run(spark, scratch):
    src, out, chk = _local(scratch("rs-src")), scratch("rs-out"), scratch("rs-chk")
    _write_batches(src, LATE_BATCHES[:3])
    _run_views(spark, src, out, chk)
    _write_batches(src, LATE_BATCHES[3:], first=3)
    _run_views(spark, src, out, chk)
    assert _counts(spark, out) == [(9, 1), (10, 2), (12, 2)]
    # hour partitions on disk
    assert sorted(os.path.basename(p) for p in glob.glob(_local(out) + "/hour=*")) == [
        "hour=2024010109", "hour=2024010110", "hour=2024010112",
    ]


def test_stream_equals_batch_before_watermark(spark, scratch):
    out = catalog.q_product_views_stream(spark, SF_SMALL)
    batch = catalog.views(spark, SF_SMALL)
    cws = catalog.clicks_with_state(spark, SF_SMALL)
    cutoff = cws.agg(F.max("date_time")).first()[0] - dt.timedelta(hours=1)
    closed = batch.filter(F.col("period_start") + F.expr("INTERVAL 1 HOUR") <= F.lit(cutoff))
    assert out.count() == closed.count()
    assert out.exceptAll(closed).count() == 0


def test_record_job_partitions_by_zip(spark, scratch):
    out, chk = scratch("rec-out"), scratch("rec-chk")
    q = record_clicks(event_lines(events_stream(spark, SF_SMALL)), out, chk, trigger="availableNow")
    q.awaitTermination()
    back = spark.read.schema(CLICK_RECORD).parquet(out)
    assert back.count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    zips = glob.glob(_local(out) + "/zip_code=*")
    assert len(zips) == back.select("zip_code").distinct().count()


def test_csv_sink_with_pipe_separator(spark, scratch):
    src, out, chk = _local(scratch("csv-src")), scratch("csv-out"), scratch("csv-chk")
    _write_batches(src, LATE_BATCHES)
    q = start_views_per_state(
        text_lines_stream(spark, src), dev_zip_states(spark), out, chk, window=TUMBLING,
        fmt="csv", partition_by="hour", trigger="availableNow",
    )
    q.awaitTermination()
    files = [f for f in glob.glob(_local(out) + "/hour=*/*.csv") if os.path.getsize(f)]
    assert files
    first = open(files[0]).readline().strip().split("|")
    assert first[0] == "7" and first[1] == "State 10001"


def test_fan_out_feeds_several_sinks(spark, scratch):
    src, chk = _local(scratch("fan-src")), scratch("fan-chk")
    a, b = scratch("fan-a"), scratch("fan-b")
    _write_batches(src, LATE_BATCHES)
    clicks = with_state(click_times(text_lines_stream(spark, src, max_files=2)), dev_zip_states(spark))
    sinks = [epoch_sink(a), epoch_sink(b, build=lambda batch: batch.groupBy("product_id").count())]
    start_fan_out(clicks, sinks, chk, trigger="availableNow").awaitTermination()
    assert read_epochs(spark, a, clicks.schema).count() == 7
    counts = read_epochs(spark, b, "product_id long, count long")
    assert counts.agg(F.sum("count")).first()[0] == 7


def test_fan_out_counts_a_retried_batch_once(spark, scratch):
    src, chk, a = _local(scratch("retry-src")), scratch("retry-chk"), scratch("retry-a")
    _write_batches(src, LATE_BATCHES[:3])
    failed = []

    def fails_once(batch, epoch):
        if not failed:
            failed.append(epoch)
            raise RuntimeError("second sink is down")

    clicks = click_times(text_lines_stream(spark, src))
    with pytest.raises(Exception, match="second sink is down"):
        start_fan_out(clicks, [epoch_sink(a), fails_once], chk, trigger="availableNow").awaitTermination()
    start_fan_out(clicks, [epoch_sink(a), fails_once], chk, trigger="availableNow").awaitTermination()
    assert failed and read_epochs(spark, a, clicks.schema).count() == 4


def test_streaming_views_shape(spark):
    s = views_per_state_stream(event_lines(events_stream(spark, SF_SMALL)), catalog.zip_states(spark, SF_SMALL))
    assert s.isStreaming
    assert s.columns == ["product_id", "state", "count", "period_start", "hour"]


def test_kafka_source_needs_connector(spark):
    from clickpanes.sources.kafka import kafka_lines, kafka_reader

    reader = kafka_reader(spark, "host:9092", "clicks", {"startingOffsets": "earliest"})
    assert reader is not None
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_lines(spark, "host:9092", "clicks")


def test_named_query_and_console_sink(spark, scratch, capsys):
    from clickpanes.streaming.sinks import start_console

    src, out, chk = _local(scratch("nm-src")), scratch("nm-out"), scratch("nm-chk")
    _write_batches(src, LATE_BATCHES[:1])
    q = _run_views(spark, src, out, chk)
    assert q.name == "product_views_per_state_per_hour"
    c = start_console(click_times(text_lines_stream(spark, src)), "raw_clicks", trigger="availableNow")
    c.awaitTermination()
    assert c.name == "raw_clicks" and c.recentProgress[0]["numInputRows"] == 1


def test_late_click_counts_in_every_open_window(spark, scratch):
    """The 11:31 click comes when its pane and its first windows have closed
    (watermark 12:01); the windows from 11:05 on are open and count it."""
    src, out, chk = _local(scratch("open-src")), scratch("open-out"), scratch("open-chk")
    _write_batches(src, [["10:02"], ["13:00"], ["13:01"], ["11:31"], ["18:00"], ["18:01"]])
    q = start_views_per_state(
        text_lines_stream(spark, src, max_files=1), dev_zip_states(spark), out, chk,
        partition_by=None, trigger="availableNow",
    )
    q.awaitTermination()
    rows = spark.read.schema(PRODUCT_VIEWS).parquet(out).collect()
    by_start = {r.period_start.strftime("%H:%M"): r["count"] for r in rows}
    assert len(rows) == 30 and sum(by_start.values()) == 42
    late = [f"11:{m:02d}" for m in range(5, 35, 5)]
    assert all(s in by_start for s in late) and "11:00" not in by_start


def test_late_query_holds_late_clicks_in_open_windows(spark):
    from clickpanes.plans.oracle import LATE_IN_OPEN_WINDOWS
    from compare import duck
    from conftest import SF_MID

    assert duck(SF_MID).execute(LATE_IN_OPEN_WINDOWS).fetchone()[0] > 0


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_far_times_in_a_stream(spark, scratch, ansi):
    src, out, chk = _local(scratch("far-src")), scratch("far-out"), scratch("far-chk")
    os.makedirs(src)
    with open(f"{src}/a.txt", "w") as fh:
        fh.write("1|7|10001|1|1|2200/01/01 05:00:00\n1|7|10001|1|1|2024/01/01 05:00:00\n1|7|10001|1|1|9999/12/31 00:00:00\n")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        start_views_per_state(
            text_lines_stream(spark, src), dev_zip_states(spark), out, chk, partition_by="hour", trigger="availableNow",
        ).awaitTermination()
        hours = {r.hour for r in spark.read.schema(PRODUCT_VIEWS).parquet(out).collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert hours == {2024010104, 2024010105, 2200010104, 2200010105}


def test_hour_store_has_few_files(spark, scratch):
    from clickpanes.streaming.sinks import FILES_PER_KEY

    out, chk = scratch("few-out"), scratch("few-chk")
    start_views_per_state(
        event_lines(events_stream(spark, SF_SMALL)), catalog.zip_states(spark, SF_SMALL), out, chk, trigger="availableNow",
    ).awaitTermination()
    hours = glob.glob(_local(out) + "/hour=*")
    files = glob.glob(_local(out) + "/hour=*/*.parquet")
    assert len(hours) > 100 and len(files) <= FILES_PER_KEY * len(hours)


def test_streams_leave_no_cached_table(spark, scratch):
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
