"""Gap-free views: every series gets a row at every stamp of a time grid.

A series is one ``(product_id, state)`` pair. The grid is generated per
series with ``sequence`` + ``explode`` (a generator, no join). Observed counts stand at their
positions on the grid; each is expanded over the gap up to the next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpanes.functions.timekeys import first_stamp, hour_key, stamps_after

SERIES = ["product_id", "state"]


def series_keys(views: DataFrame) -> DataFrame:
    """Distinct ``(product_id, state)`` pairs observed in the views."""
    return views.select(*SERIES).distinct()


#: Stamps of a series that one task fills as a group.
CHUNK = 4096


def _ts(start: str | Column) -> Column:
    """A start as a timestamp. Text that is none is an error, with ANSI mode on or off."""
    if not isinstance(start, str):
        return start
    wrong = F.raise_error(F.lit(f"start is no timestamp: {start!r}")).cast("timestamp")
    return F.coalesce(F.lit(start).try_cast("timestamp"), wrong)


def view_grid(keys: DataFrame, start: str | Column, steps: int, step_s: int = 300) -> DataFrame:
    """``keys`` x ``steps + 1`` stamps ``step_s`` seconds apart, the first
    one step after ``start``; columns ``*keys, period_start, hour``.

    Each key row is expanded where it lies, so the work spreads with the
    key table's partitions and no key pair is ever compared with another.
    """
    stamps = stamps_after(_ts(start), steps, step_s)
    grid = keys.select(*keys.columns, F.explode(stamps).alias("period_start"))
    return grid.withColumn("hour", hour_key("period_start"))


def series_of(products: DataFrame, states: DataFrame, state_buckets: int = 64) -> DataFrame:
    """``product_id, state``: the series of given products and states.

    The states (a short list: distinct values of a dimension) are gathered
    into ``state_buckets`` arrays and each product row is expanded with them.
    A NULL state is one like any other.
    """
    bucket = F.pmod(F.xxhash64("state"), F.lit(state_buckets)).cast("int")
    lists = states.distinct().groupBy(bucket.alias("_b")).agg(F.collect_list(F.struct("state")).alias("_states"))
    each = F.explode(F.sequence(F.lit(0), F.lit(state_buckets - 1))).alias("_b")
    ids = products.select(F.col("product_id").cast("bigint").alias("product_id")).distinct()
    return ids.select("product_id", each).join(lists, "_b").select("product_id", F.explode("_states").alias("_state")).select("product_id", "_state.state")


def fill_views(
    views: DataFrame,
    keys: DataFrame,
    start: str | Column,
    steps: int,
    step_s: int = 300,
    positive_only: bool = False,
) -> DataFrame:
    """Every series of ``keys`` (a set) at every stamp of the span, with the observed
    count, 0 where nothing was seen.

    The views are cut to the span first, on ``hour`` too, so a store
    partitioned by hour is read only for the grid's hours. A series' span is cut into chunks of ``CHUNK`` stamps, each a
    group of its own. In a chunk, the observed counts (and a 0 at its first stamp) are put in
    order, and each fills the stamps up to the next one: work and rows are linear in the stamps, no
    row holds a series' span, and the grid itself is never shuffled. NULL product ids and states are
    series like any other. ``positive_only`` keeps the rows with ``count > 0``, which are observed
    ones, so no grid is generated.
    """
    step_us = step_s * 1_000_000
    first = first_stamp(_ts(start), step_s)
    at = F.unix_micros("period_start") - first
    begin, end = F.timestamp_micros(first), F.timestamp_micros(first + F.lit(steps * step_us))
    seen = (
        views.filter(
            F.col("hour").between(hour_key(begin), hour_key(end))
            & F.col("period_start").between(begin, end)
            & (F.pmod(at, F.lit(step_us)) == 0)
        )
        .select(*SERIES, "count", F.round(at / F.lit(step_us)).cast("bigint").alias("_at"))
        .groupBy(*SERIES, "_at")
        .agg(F.sum("count").cast("bigint").alias("count"))
    )
    keys = keys.select(*SERIES)

    def shaped(rows: DataFrame) -> DataFrame:
        stamp = F.timestamp_micros(first + F.col("_at") * F.lit(step_us))
        return rows.select(*SERIES, "count", stamp.alias("period_start")).withColumn("hour", hour_key("period_start"))

    if positive_only:
        known = keys.select(*[F.col(c).alias(f"_{c}") for c in SERIES])
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in SERIES]
        return shaped(seen.filter(F.col("count") > 0).join(known, same[0] & same[1], "left_semi"))
    chunk = lambda: F.floor(F.col("_at") / CHUNK).cast("bigint").alias("_chunk")
    begins = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(steps).cast("bigint"), F.lit(CHUNK).cast("bigint")))
    marks = keys.select(*SERIES, begins.alias("_at"), F.lit(0).cast("bigint").alias("count"), F.lit(1).alias("_wanted"))
    rows = marks.unionByName(seen.withColumn("_wanted", F.lit(0)))
    rows = rows.groupBy(*SERIES, chunk(), "_at").agg(F.sum("count").alias("count"), F.max("_wanted").alias("_wanted"))
    group = Window.partitionBy(*SERIES, "_chunk")
    stop = F.least((F.col("_chunk") + 1) * CHUNK, F.lit(steps + 1).cast("bigint"))
    rows = rows.withColumns({
        "_next": F.coalesce(F.lead("_at").over(group.orderBy("_at")), stop),
        "_known": F.max("_wanted").over(group),
    }).filter("_known = 1")
    filled = rows.select(*SERIES, "count", F.col("_at").alias("_from"), F.explode(F.sequence("_at", F.col("_next") - 1)).alias("_at"))
    return shaped(filled.withColumn("count", F.when(F.col("_at") == F.col("_from"), F.col("count")).otherwise(F.lit(0).cast("bigint"))))
