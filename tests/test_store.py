"""Stores with a commit log: replayed, failed, concurrent and compacted runs; slices that skip pages."""

import datetime as dt
import glob
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickpanes import store
from clickpanes.operators.featured import closing_starts, featured_from_store, featured_products, hour_slice, hour_slice_stored
from clickpanes.plans import catalog
from clickpanes.plans.grid import backfill_grid
from clickpanes.schemas import CLICK_RECORD, PRODUCT_VIEWS
from clickpanes.sinks import VIEW_ORDER, write_views
from clickpanes.sources.files import read_views
from clickpanes.streaming.sinks import epoch_sink, read_epochs, start_fan_out, start_store_sink
from conftest import SF_MID, SF_SMALL

VIEWS = "product_id long, state string, count long, period_start timestamp, hour long"


def _local(path):
    return path.replace("file:", "")


def _files(path):
    return glob.glob(f"{_local(path)}/*/*.parquet")


def _views(spark, rows):
    """rows: (product, count, hour of 2024-01-01, minute)."""
    return spark.createDataFrame([(p, "S", n, dt.datetime(2024, 1, 1, h, m), 2024010100 + h) for p, n, h, m in rows], VIEWS)


def _counts(df):
    return sorted((r.product_id, r["count"], r.hour % 100) for r in df.collect())


def test_a_run_done_again_replaces_itself(spark, scratch):
    path = scratch("store")
    write_views(_views(spark, [(1, 5, 3, 0), (2, 6, 4, 0)]), path, run="a/b *1")
    write_views(_views(spark, [(3, 7, 3, 0)]), path, run="other")
    assert _counts(read_views(spark, path)) == [(1, 5, 3), (2, 6, 4), (3, 7, 3)]
    write_views(_views(spark, [(1, 9, 5, 0)]), path, run="a/b *1")
    assert _counts(read_views(spark, path)) == [(1, 9, 5), (3, 7, 3)]
    # A reader without the log sees the same, since replaced files are deleted.
    assert _counts(spark.read.schema(PRODUCT_VIEWS).parquet(path)) == [(1, 9, 5), (3, 7, 3)]
    write_views(_views(spark, []), path, run="other")
    assert _counts(read_views(spark, path)) == [(1, 9, 5)]


def test_a_run_killed_before_its_commit_leaves_nothing(spark, scratch, monkeypatch):
    path = scratch("store")
    write_views(_views(spark, [(1, 5, 3, 0)]), path, run="a")

    def killed(self, change):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(store.Log, "commit", killed)
        for run in ("a", "b"):
            with pytest.raises(KeyboardInterrupt):
                write_views(_views(spark, [(8, 8, 3, 0)]), path, run=run)
        empty = scratch("never")
        with pytest.raises(KeyboardInterrupt):
            write_views(_views(spark, [(8, 8, 3, 0)]), empty, run="a")
    assert _counts(read_views(spark, path)) == [(1, 5, 3)]
    assert len(_files(path)) == 3 and store.sweep(spark, path) == 2 and len(_files(path)) == 1
    write_views(_views(spark, [(2, 2, 3, 0)]), path, run="b")
    assert _counts(read_views(spark, path)) == [(1, 5, 3), (2, 2, 3)]


def test_backfill_run_twice_equals_once(spark, scratch):
    once, twice = scratch("once"), scratch("twice")
    views = catalog.views(spark, SF_SMALL)
    for path in (once, twice, twice):
        backfill_grid(views, path, "2024-01-01 00:55:00", 23, 300, run="2024-01-01")
    a, b = read_views(spark, once), read_views(spark, twice)
    assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0


def test_writers_that_meet_both_count(spark, scratch):
    path = scratch("log")
    log, calls = store.Log(spark, path), []

    def add(name):
        return lambda t: t | {"marks": t["marks"] | {name: 1}}

    def slow(table):
        calls.append(1)
        if len(calls) == 1:  # another writer commits between this one's read and its commit
            store.Log(spark, path).commit(add("quick"))
        return add("slow")(table)

    log.commit(slow)
    assert len(calls) == 2 and log.state()["marks"] == {"quick": 1, "slow": 1}
    for k in range(20):
        log.commit(add(f"x{k}"))
    assert len(log.numbers()) <= store.KEPT_STATES + 1 and len(log.state()["marks"]) == 22
    log.commit(lambda t: t)
    assert len(log.state()["marks"]) == 22


def test_compaction_folds_closed_hours(spark, scratch, monkeypatch):
    path = scratch("compact")
    rows = {k: [(k, 10 + k, h, 0) for h in (1, 2, 5)] for k in range(4)}
    for k in range(4):
        store.publish(store.by_value(_views(spark, rows[k]), "hour", VIEW_ORDER), path, f"batch-s-{k}", "hour", mark=("s", k))
    write_views(_views(spark, [(9, 9, 1, 0)]), path, run="by hand")
    want = _counts(read_views(spark, path))
    args = (PRODUCT_VIEWS, "hour", VIEW_ORDER, 2024010102)
    with monkeypatch.context() as m:
        m.setattr(store.Log, "commit", lambda self, change: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            store.compact(spark, path, *args)
    assert _counts(read_views(spark, path)) == want
    store.sweep(spark, path)
    assert store.compact(spark, path, *args) == 4
    assert _counts(read_views(spark, path)) == want == _counts(spark.read.schema(PRODUCT_VIEWS).parquet(path))
    by_hour = Counter(os.path.basename(os.path.dirname(f)) for f in _files(path))
    assert by_hour == {"hour=2024010101": 2, "hour=2024010102": 1, "hour=2024010105": 4}
    assert store.compact(spark, path, *args) == 0  # done already
    # A late batch adds rows to a folded hour; a batch that comes again is known.
    late = store.by_value(_views(spark, [(7, 7, 1, 5)]), "hour", VIEW_ORDER)
    assert store.publish(late, path, "batch-s-4", "hour", mark=("s", 4))
    assert not store.publish(late, path, "batch-s-4", "hour", mark=("s", 4))
    assert not store.publish(late, path, "batch-s-1", "hour", mark=("s", 1))
    want = sorted([*want, (7, 7, 1)])
    assert store.compact(spark, path, PRODUCT_VIEWS, "hour", VIEW_ORDER) == 5
    assert _counts(read_views(spark, path)) == want
    assert len([f for f in _files(path) if "compacted" in f]) == 2 + 2


def test_a_folded_run_cannot_be_replaced(spark, scratch):
    path = scratch("folded")
    write_views(_views(spark, [(1, 5, 3, 0)]), path, run="day-1")
    write_views(_views(spark, [(2, 5, 3, 0)]), path, run="day-2")
    assert store.compact(spark, path, PRODUCT_VIEWS, "hour", VIEW_ORDER, prefix="day-") == 2
    with pytest.raises(ValueError, match="compacted"):
        write_views(_views(spark, [(1, 6, 3, 0)]), path, run="day-1")
    assert _counts(read_views(spark, path)) == [(1, 5, 3), (2, 5, 3)]


def _tagged(files):
    """Files by folder and run."""
    return Counter((os.path.dirname(f), store._FILE.match(os.path.basename(f))[1]) for f in files)


def test_recordings_have_one_file_a_folder_and_batch(spark, scratch):
    path, chk = scratch("rec"), scratch("rec-chk")
    from clickpanes.plans.record import record_clicks

    record_clicks(catalog.lines_stream(spark, SF_SMALL), path, chk, trigger="availableNow").awaitTermination()
    files = _tagged(_files(path))
    assert len(files) > 10 and sum(files.values()) / len(files) <= 1.2
    assert store.sweep(spark, path) == 0
    assert store.read_store(spark, path, CLICK_RECORD, "zip_code").count() == catalog.lines(spark, SF_SMALL).count()


@pytest.mark.parametrize("hot", [7, None])
def test_a_hot_value_is_shared_by_tasks(spark, scratch, hot):
    """A key with a third of the rows is written by three tasks or more, the others by one each."""
    path, chk, src = scratch("hot"), scratch("hot-chk"), scratch("hot-src")
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id") % 50 + 100).cast("int").alias("zip_code"), "id")
    rows.write.parquet(src)
    stream = spark.readStream.schema("zip_code int, id long").parquet(src)
    share = 30_000 * 16 // 8
    start_store_sink(stream, path, chk, "zip_code", ["id"], trigger="availableNow", file_bytes=share).awaitTermination()
    files = Counter(os.path.basename(os.path.dirname(f)) for f in _files(path))
    name = "zip_code=__HIVE_DEFAULT_PARTITION__" if hot is None else f"zip_code={hot}"
    tasks = {f[len(os.path.dirname(f)) + 1 + len(store._FILE.match(os.path.basename(f))[1]) :][:6] for f in _files(path) if name in f}
    assert files.pop(name) >= 3 and len(tasks) >= 3
    assert set(files.values()) == {1} and len(files) == 50
    back = store.read_store(spark, path, rows.schema, "zip_code")
    assert back.select("id").distinct().count() == back.count() == 30_000


def test_a_replayed_batch_counts_once(spark, scratch, monkeypatch):
    """A batch that was committed but not checkpointed comes again."""
    path, chk, src = scratch("replay"), scratch("replay-chk"), scratch("replay-src")
    spark.range(100).selectExpr("id % 4 AS k", "id").write.parquet(src)
    stream = spark.readStream.schema("k long, id long").parquet(src)
    run = lambda: start_store_sink(stream, path, chk, "k", ["id"], trigger="availableNow").awaitTermination()
    run()
    commits = sorted(glob.glob(f"{_local(chk)}/commits/[0-9]*"), key=lambda f: int(os.path.basename(f)))
    for f in (commits[-1], os.path.join(os.path.dirname(commits[-1]), f".{os.path.basename(commits[-1])}.crc")):
        if os.path.exists(f):
            os.remove(f)
    run()
    assert store.read_store(spark, path, stream.schema, "k").count() == 100 == spark.read.parquet(path).count()


def test_fan_out_shows_an_epoch_of_all_sinks_or_of_none(spark, scratch):
    src, chk, log, a, b = (scratch(x) for x in ("fan-src", "fan-chk", "fan-log", "fan-a", "fan-b"))
    spark.range(0, 10).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(src)
    down = [False]

    def second(batch, epoch):
        if down[0]:
            raise RuntimeError("second sink is down")
        epoch_sink(b)(batch, epoch)

    def run():
        start_fan_out(stream, [epoch_sink(a), second], chk, trigger="availableNow", commit_to=log).awaitTermination()

    def seen():
        return [read_epochs(spark, p, "id long", commit_to=log).count() for p in (a, b)]

    assert seen() == [0, 0]
    run()
    assert seen() == [10, 10]
    spark.range(10, 15).coalesce(1).write.mode("append").parquet(src)
    down[0] = True
    with pytest.raises(Exception, match="second sink is down"):
        run()
    assert seen() == [10, 10] and read_epochs(spark, a, "id long").count() == 15  # the first sink has written it
    down[0] = False
    run()
    assert seen() == [15, 15]


def _scan_rows(df):
    """Rows that the file scans of a collected query returned."""
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    leaves = plan.collectLeaves()
    for k in range(leaves.size()):
        metric = leaves.apply(k).metrics().get("numOutputRows")
        total += metric.get().value() if metric.isDefined() else 0
    return total


def test_slice_reads_a_sixth_of_the_day_at_most(spark, scratch):
    """A day of many products, so that an hour has many pages."""
    path, date = scratch("slice"), "2024-01-15"
    day = catalog.views(spark, SF_MID).where(F.col("hour").between(2024011500, 2024011523))
    many = day.crossJoin(spark.range(80)).select((F.col("product_id") + 10_000 * F.col("id")).alias("product_id"), "state", "count", "period_start", "hour")
    write_views(many, path)
    views = read_views(spark, path)
    part = hour_slice_stored(views, date)
    rows = part.collect()
    assert Counter(rows) == Counter(hour_slice(views, date).collect()) and len(rows) > 1000
    total = views.count()
    assert len(rows) <= _scan_rows(part) <= total / 6
    scan = str(part._jdf.queryExecution().executedPlan().toString())
    assert "PushedFilters" in scan and "PartitionFilters" in scan


def test_stored_report_equals_the_other(spark, scratch):
    path = scratch("report")
    write_views(catalog.views(spark, SF_SMALL), path)
    views, products = read_views(spark, path), catalog.products(spark, SF_SMALL)
    for date in ("2024-01-01", "2024-01-15", "1999-01-01"):
        for anchor in ("hour00", "day"):
            want = featured_products(views, date, products, anchor=anchor).collect()
            assert featured_from_store(views, date, products, anchor=anchor).collect() == want
    assert closing_starts(views, "1999-01-01") == [] and len(closing_starts(views, "2024-01-15")) == 24


@pytest.mark.parametrize("zone,date,hours", [("Europe/Berlin", "2024-03-31", 23), ("Europe/Berlin", "2024-10-27", 25), ("Australia/Lord_Howe", "2024-04-07", 24)])
def test_slice_where_clocks_change(spark, scratch, zone, date, hours):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        from clickpanes.functions.timekeys import hour_key

        start = F.timestamp_micros(F.unix_micros(F.lit(f"{date} 00:00:00").cast("timestamp")) + F.col("id") * 300_000_000)
        rows = spark.range(-40, 340).select(F.col("id").alias("product_id"), F.lit("S").alias("state"), F.lit(1).cast("long").alias("count"), start.alias("period_start"))
        path = scratch("zone")
        write_views(rows.withColumn("hour", hour_key("period_start")), path)
        views = read_views(spark, path)
        got, want = (sorted(r.product_id for r in f(views, date).collect()) for f in (hour_slice_stored, hour_slice))
        assert got == want and abs(len(got) - hours) <= 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_many_folders_cost_few_tasks_and_no_files_beside_the_data(spark, scratch):
    """A store's folders are listed by a number of tasks that does not grow with them, and a value's file has no companion."""
    path, group = scratch("wide"), "wide-listing"
    folders = store.LISTERS * spark.sparkContext.defaultParallelism + 20
    rows = spark.range(2 * folders).select((F.col("id") % folders).alias("k"), "id")
    before = spark.conf.get(store._LISTING)
    assert store.publish(store.by_value(rows, "k", ["id"]), path, "one", "k")
    assert not glob.glob(f"{_local(path)}/k=*/.*.crc") and len(_files(path)) >= folders
    spark.sparkContext.setJobGroup(group, group)
    try:
        back = store.read_store(spark, path, rows.schema, "k")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    tasks = [tracker.getStageInfo(s).numTasks for s in stages]
    assert tasks and max(tasks) <= store.LISTERS * spark.sparkContext.defaultParallelism
    assert spark.conf.get(store._LISTING) == before
    assert sorted(r.id for r in back.collect()) == list(range(2 * folders))


def test_a_damaged_page_is_an_error(spark, scratch):
    path = scratch("damaged")
    rows = spark.range(20_000).select(F.lit(1).alias("k"), F.xxhash64("id").alias("v"))
    store.publish(store.by_value(rows, "k", []), path, "one", "k", page_rows=20_000)
    (file,) = _files(path)
    with open(file, "r+b") as f:
        f.seek(os.path.getsize(file) // 2)
        old = f.read(1)
        f.seek(-1, os.SEEK_CUR)
        f.write(bytes([old[0] ^ 0x55]))
    with pytest.raises(Exception, match="(?i)crc|checksum|corrupt"):
        store.read_store(spark, path, rows.schema, "k").agg(F.sum("v")).collect()
