"""Product views per state as a stateful streaming aggregation.

One aggregation over the sliding window, as the job defines it: a click is
counted in each of its windows that is still open (its end lies after the
watermark, the latest event time seen minus ``delay``), however late it
comes, and a window is emitted once the watermark passes its end. Counting
clicks into panes first would use less state, but a pane closes before the
windows that cover it, so late clicks would be lost for windows that are
still open.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpanes.config import DEFAULT_WINDOW, ViewWindow
from clickpanes.operators.views import shape_views


def windowed_views(clicks: DataFrame, window: ViewWindow = DEFAULT_WINDOW) -> DataFrame:
    """``product_id, state, count, period_start, hour`` from a stream of
    ``product_id, state, date_time`` (event time must be a ``timestamp``)."""
    counts = (
        clicks.withWatermark("date_time", window.delay_text)
        .groupBy(F.window("date_time", window.size, window.slide).alias("w"), "product_id", "state")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return shape_views(counts.withColumn("period_start", F.col("w.start")))


def open_views(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The counts of the windows a ``windowed_views`` stream has not emitted yet, in the same columns, read
    from its checkpoint by the state data source (as of the last committed batch; the stream may be running or stopped)."""
    state = spark.read.format("statestore").load(checkpoint)
    counts = state.select("key.*", "value.*")
    # Of the key, the window is the only struct; of the value, there is the count alone.
    window = next(f.name for f in state.schema["key"].dataType.fields if f.name.startswith(("w", "window")))
    count = state.schema["value"].dataType.fields[0].name
    return shape_views(counts.select("product_id", "state", F.col(count).alias("count"), F.col(f"{window}.start").alias("period_start")))
