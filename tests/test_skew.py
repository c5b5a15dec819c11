"""Hot keys by sketch and the salted join; open windows from the checkpoint."""

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from clickpanes.operators.dims import with_state
from clickpanes.operators.skew import hot_keys, key_sketch, merge_sketches
from clickpanes.plans import catalog
from clickpanes.plans.views import publish_open_views, read_views_with_open, start_views_per_state
from clickpanes.sources.files import dev_zip_states, read_views, text_lines_stream
from clickpanes.streaming.sinks import start_file_sink
from conftest import SF_MID, SF_SMALL


@pytest.fixture()
def shuffled(spark):
    """No broadcast by size and no adaptive execution, as a stateful stream is planned."""
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def test_sketches_merge(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id") + 100).alias("k"))
    parts = [key_sketch(df.where(F.pmod(F.hash("k"), F.lit(3)) == i), "k") for i in range(3)]
    one, three = hot_keys(key_sketch(df, "k"), 8).collect(), hot_keys(merge_sketches(parts[0].union(parts[1]).union(parts[2])), 8).collect()
    assert one == three and [r.key for r in one] == [7] and one[0].salts == -(-5000 * 8 * 16 // 9000)
    assert hot_keys(key_sketch(df.limit(0), "k"), 8).count() == 0


def _task_rows(path):
    """Rows of every file, each written by one task."""
    return [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(path.replace("file:", "") + "/*.parquet")]


@pytest.mark.parametrize("salt", [True, False])
def test_hot_zip_is_spread_in_the_stream(shuffled, scratch, salt):
    spark = shuffled
    recorded = catalog.skewed_clicks(catalog.lines(spark, SF_MID))
    hot = hot_keys(key_sketch(recorded, "zip_code")) if salt else None
    assert hot is None or catalog.HOT_ZIP in [r.key for r in hot.collect()]
    out, chk = scratch("skew-out"), scratch("skew-chk")
    joined = with_state(catalog.skewed_clicks(catalog.lines_stream(spark, SF_MID)), catalog.zip_states(spark, SF_MID), hot=hot)
    start_file_sink(joined, out, chk, trigger="availableNow").awaitTermination()
    rows = _task_rows(out)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    want = with_state(recorded, catalog.zip_states(spark, SF_MID))
    assert sum(rows) == want.count()
    spread = max(rows) / (sum(rows) / n)
    assert spread < 2 if salt else spread > 3
    back = spark.read.schema(joined.schema).parquet(out)
    assert back.exceptAll(want).count() == 0


def test_hot_keys_keep_unknown_null_and_doubled_zips(spark):
    rows = [(k, z, dt.datetime(2024, 1, 1, 0, 0, k % 60)) for k, z in enumerate([5] * 50 + [None] * 30 + [6] * 3 + [7])]
    clicks = spark.createDataFrame(rows, "product_id long, zip_code int, date_time timestamp")
    dims = spark.createDataFrame([(5, "A"), (5, "B"), (6, None), (None, "N")], "zip_code int, state string")
    hot = hot_keys(key_sketch(clicks, "zip_code"), 4)
    assert [r.key for r in hot.collect()] == [5]
    plain, split = with_state(clicks, dims), with_state(clicks, dims, hot=hot)
    assert split.count() == plain.count() == 50 * 2 + 34 and plain.exceptAll(split).count() == 0


def test_open_windows_become_final(spark, scratch):
    """Provisional counts of open windows give way to the final ones when these are emitted."""
    src, out, chk, still = (scratch(f"open-{x}") for x in ("src", "out", "chk", "views"))
    folder = src.replace("file:", "")
    os.makedirs(folder)

    def deliver(name, times):
        with open(f"{folder}/{name}.txt", "w") as fh:
            fh.writelines(f"1|7|10001|1|1|2024/01/01 {t}:00\n" for t in times)
        start_views_per_state(
            text_lines_stream(spark, src), dev_zip_states(spark), out, chk, partition_by=None, trigger="availableNow"
        ).awaitTermination()

    def seen():
        return {r.period_start.strftime("%H:%M"): (r["count"], r.provisional) for r in read_views_with_open(spark, out, still).collect()}

    deliver("a", ["10:02", "10:04"])
    publish_open_views(spark, chk, still)
    first = seen()
    assert len(first) == 12 and set(first.values()) == {(2, True)}
    deliver("b", ["10:31", "14:00"])
    between = seen()  # final counts are there, the old provisional ones are not counted beside them
    assert between["09:05"] == (2, False) and between["10:00"] == (3, False) and not any(p for _, p in between.values())
    publish_open_views(spark, chk, still)
    last = seen()
    assert last["10:00"] == (3, False) and last["13:30"] == (1, True) and len(last) == len(between) + 12
    assert read_views(spark, still).count() == 12


def test_emitted_and_open_are_the_batch_counts(spark):
    got, want = catalog.q_views_stream_with_open(spark, SF_SMALL), catalog.views(spark, SF_SMALL)
    assert got.where("provisional").count() > 0
    got = got.drop("provisional")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
