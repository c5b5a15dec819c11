"""Time stamps generation and gap filling."""

import datetime as dt
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickpanes.functions import stamps_after
from clickpanes.functions.timekeys import hour_key
from clickpanes.operators import grid
from clickpanes.operators.grid import fill_views, series_of, view_grid
from clickpanes.plans.grid import gap_filled_views


def test_stamps_after_counts_and_offsets(spark):
    start = dt.datetime(2024, 1, 1, 10, 0, 0, 123456)
    row = spark.range(1).select(stamps_after(F.lit(start), 2, 300).alias("s")).first()
    assert row.s == [dt.datetime(2024, 1, 1, 10, 5), dt.datetime(2024, 1, 1, 10, 10),
                     dt.datetime(2024, 1, 1, 10, 15)]


VIEWS = "product_id long, state string, count long, period_start timestamp, hour long"


def test_fill_zero_and_positive_only(spark):
    keys = spark.createDataFrame([(1, "A"), (2, "B")], "product_id long, state string")
    grid = view_grid(keys, "2024-01-01 09:55:00", 2, 300)
    assert grid.count() == 6
    views = spark.createDataFrame(
        [(1, "A", 4, dt.datetime(2024, 1, 1, 10, 5), 2024010110),
         (1, "A", 9, dt.datetime(2024, 1, 1, 11, 0), 2024010111),
         (1, "A", 7, dt.datetime(2024, 1, 1, 10, 6), 2024010110)],
        VIEWS,
    )
    full = fill_views(views, keys, "2024-01-01 09:55:00", 2, 300)
    assert full.drop("count").exceptAll(grid).count() == 0 and full.count() == 6
    assert sum(r["count"] for r in full.collect()) == 4
    pos = fill_views(views, keys, "2024-01-01 09:55:00", 2, 300, positive_only=True).collect()
    assert [(r.product_id, r["count"]) for r in pos] == [(1, 4)]


def test_null_series_keep_their_counts(spark):
    rows = [(None, "S", 4), (3, None, 5), (None, None, 6), (3, "S", 7)]
    views = spark.createDataFrame([(*r, dt.datetime(2024, 1, 1, 10, 0), 2024010110) for r in rows], VIEWS)
    got = gap_filled_views(views, "2024-01-01 09:55:00", 1, 300, positive_only=True).collect()
    assert sorted((r[0] or 0, r[1] or "", r[2]) for r in got) == [(0, "", 6), (0, "S", 4), (3, "", 5), (3, "S", 7)]
    full = gap_filled_views(views, "2024-01-01 09:55:00", 1, 300)
    assert full.count() == 8


def test_series_of_products_and_states(spark):
    products = spark.createDataFrame([(1,), (2,), (2,)], "product_id int")
    states = spark.createDataFrame([("A",), ("B",), ("A",)], "state string")
    assert sorted(tuple(r) for r in series_of(products, states).collect()) == [(1, "A"), (1, "B"), (2, "A"), (2, "B")]


def test_series_of_keeps_the_null_state(spark):
    products = spark.createDataFrame([(1,), (2,)], "product_id int")
    states = spark.createDataFrame([("A",), (None,), (None,)], "state string")
    assert sorted(map(str, map(tuple, series_of(products, states).collect()))) == sorted(map(str, [(1, "A"), (1, None), (2, "A"), (2, None)]))


def test_grid_start_from_now(spark):
    from clickpanes.functions.timekeys import grid_start

    now = dt.datetime(2024, 1, 1, 12, 0, 30, 999)
    assert grid_start(now, 2, 300) == dt.datetime(2024, 1, 1, 11, 50, 30)
    assert grid_start(now, 2, 300, start_delta_s=60) == dt.datetime(2024, 1, 1, 11, 59, 30)
    row = spark.range(1).select(stamps_after(F.lit(grid_start(now, 2, 300)), 2, 300).alias("s")).first()
    assert row.s[-1] == dt.datetime(2024, 1, 1, 12, 5, 30)


@pytest.mark.parametrize("chunk", [1, 2, 5, 4096])
def test_fill_by_brute_force(spark, monkeypatch, chunk):
    """Chunks of all sizes, series without keys, without counts, with NULLs and with repeated counts."""
    monkeypatch.setattr(grid, "CHUNK", chunk)
    rng, first = random.Random(chunk), dt.datetime(2024, 1, 1, 10, 0)
    keys = [(1, "A"), (2, None), (None, "B"), (4, "quiet")]
    rows = []
    for _ in range(60):
        at = first + dt.timedelta(minutes=rng.randrange(-10, 75))
        rows.append((*rng.choice([*keys[:3], (9, "no key")]), rng.choice([1, 2, 3]), at, at.year * 10**6 + at.month * 10**4 + at.day * 100 + at.hour))
    views, series = spark.createDataFrame(rows, VIEWS), spark.createDataFrame(keys, "product_id long, state string")
    want = Counter()
    for p, s, n, at, _ in rows:
        if (p, s) in keys and first <= at <= first + dt.timedelta(minutes=60) and at.minute % 5 == 0:
            want[p, s, at] += n
    full = {(*k, first + dt.timedelta(minutes=5 * i)): 0 for k in keys for i in range(13)}
    start = "2024-01-01 09:55:00"
    got = {(r[0], r[1], r.period_start): r["count"] for r in fill_views(views, series, start, 12, 300).collect()}
    assert got == full | want
    got = {(r[0], r[1], r.period_start): r["count"] for r in fill_views(views, series, start, 12, 300, positive_only=True).collect()}
    assert got == want


def test_a_year_is_filled_in_linear_time(spark):
    """One fully observed series: 26,280 and 105,120 stamps of five minutes."""

    def seconds(stamps):
        at = F.timestamp_micros(F.lit(1704067200000000) + F.col("id") * 300_000_000)
        views = spark.range(stamps).select(F.lit(1).cast("long").alias("product_id"), F.lit("S").alias("state"), (F.col("id") % 7).alias("count"), at.alias("period_start"))
        views = views.withColumn("hour", hour_key("period_start"))
        keys = spark.createDataFrame([(1, "S"), (2, "S")], "product_id long, state string")
        begin = time.perf_counter()
        n, total = fill_views(views, keys, "2023-12-31 23:55:00", stamps - 1, 300).agg(F.count("*"), F.sum("count")).first()
        assert n == 2 * stamps and total == sum(k % 7 for k in range(stamps))
        return time.perf_counter() - begin

    seconds(1000)
    short, year = min(seconds(26_280) for _ in range(2)), min(seconds(105_120) for _ in range(2))
    assert year < 4 * short + 2


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_bad_start_is_an_error(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        keys = spark.createDataFrame([(1, "A")], "product_id long, state string")
        views = spark.createDataFrame([(1, "A", 4, dt.datetime(2024, 1, 1, 10, 5), 2024010110)], VIEWS)
        for df in (view_grid(keys, "2024-13-01", 2), fill_views(views, keys, "soon", 2), fill_views(views, keys, "soon", 2, positive_only=True)):
            with pytest.raises(Exception, match="start is no timestamp"):
                df.collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
