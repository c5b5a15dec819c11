"""Small building blocks: stable buckets across engines, intervals, triggers."""

import duckdb
import pytest
from pyspark.sql import functions as F

from clickpanes.config import ViewWindow, interval_seconds
from clickpanes.functions import hour_key, stable_bucket


def test_stable_bucket_same_in_duckdb(spark):
    keys = list(range(0, 2000, 7)) + [123456789012]
    got = {
        r.k: r.b
        for r in spark.createDataFrame([(k,) for k in keys], "k long")
        .select("k", stable_bucket("k", 16).alias("b"))
        .collect()
    }
    con = duckdb.connect()
    want = dict(
        con.execute(
            "SELECT k, (('0x' || substr(md5(k::VARCHAR), 1, 8))::BIGINT % 16)::INTEGER "
            "FROM unnest(?::BIGINT[]) t(k)",
            [keys],
        ).fetchall()
    )
    assert got == want
    assert set(got.values()) == set(range(16))


@pytest.mark.parametrize("text,sec", [("1 hour", 3600), ("5 minutes", 300), ("90 seconds", 90), (" 2 days ", 172800)])
def test_interval_seconds(text, sec):
    assert interval_seconds(text) == sec


@pytest.mark.parametrize("bad", ["hour", "5 fortnights", "1.5 hours", ""])
def test_interval_seconds_rejects(bad):
    with pytest.raises(ValueError):
        interval_seconds(bad)


def test_window_defaults():
    w = ViewWindow()
    assert (w.size_s, w.slide_s, w.windows_per_event, w.delay_text) == (3600, 300, 12, "1 hour")
    assert ViewWindow("1 hour", "5 minutes", "10 minutes").delay_text == "10 minutes"


def test_hour_key(spark):
    row = spark.range(1).select(hour_key(F.lit("2024-01-15 13:59:59").cast("timestamp")).alias("h")).first()
    assert row.h == 2024011513


def test_cluster_layout_and_triggers(spark):
    from clickpanes.streaming.sinks import apply_trigger, cluster_for_write

    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    dealt = cluster_for_write(df, "k", ["v"], files_per_key=2).withColumn("task", F.spark_partition_id())
    tasks = dealt.groupBy("k").agg(F.countDistinct("task").alias("n"))
    assert all(1 <= r.n <= 2 for r in tasks.collect())
    with pytest.raises(ValueError):
        cluster_for_write(df, "k", ["v"], files_per_key=0)
    stream = spark.readStream.format("rate").load()
    w = stream.writeStream.format("noop")
    for trig in (None, "availableNow", "once", "10 seconds"):
        assert apply_trigger(w, trig) is not None
