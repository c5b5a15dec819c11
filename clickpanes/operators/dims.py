"""Dimension handling: distinct pairs and the zip -> state join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpanes.config import UNKNOWN_STATE
from clickpanes.operators.skew import copied, salted

# Clicks without a zip code match nothing; they are spread over this many
# keys above the range of zip codes, so no task gets them all.
NO_ZIP_KEY = 1 << 40
NO_ZIP_KEYS = 4096


def distinct_zip_states(zip_states: DataFrame) -> DataFrame:
    """Distinct ``(zip_code, state)`` pairs; exact duplicates collapse but a
    zip with two states keeps both (its clicks then count twice)."""
    return zip_states.select("zip_code", "state").distinct()


def distinct_states(zip_states: DataFrame) -> DataFrame:
    return zip_states.select("state").distinct()


def with_state(clicks: DataFrame, zip_states: DataFrame, dedupe: bool = True, hot: DataFrame | None = None) -> DataFrame:
    """Left join clicks to their state by zip code; unknown zip codes and
    NULL states become ``'Unknown'``.

    Input ``product_id, zip_code, date_time`` (batch or stream); output
    ``product_id, state, date_time``. The join's strategy is Spark's: it
    broadcasts the dimension where its estimated (or, under adaptive
    execution, measured) size is below ``spark.sql.autoBroadcastJoinThreshold``,
    and adaptive execution splits a hot zip code in a sort-merge join. A stateful stream
    is not planned adaptively: with ``hot`` (``skew.hot_keys`` of the recordings' zip codes) the clicks
    of hot zip codes are dealt over salts and only their dimension rows copied. A stream plans the
    dimension again in every micro-batch and so sees its changes;
    ``dedupe=False`` spares the distinct for a table without repeated pairs.
    """
    pairs = zip_states.select("zip_code", "state")
    dim = (distinct_zip_states(pairs) if dedupe else pairs).where("zip_code IS NOT NULL")
    dim = dim.select(F.col("zip_code").cast("bigint").alias("_zip"), "state")
    spread = F.lit(NO_ZIP_KEY) + F.pmod(F.xxhash64("product_id", "date_time"), F.lit(NO_ZIP_KEYS))
    zip_key = F.coalesce(F.col("zip_code").cast("bigint"), spread)
    keyed, on = clicks.select("product_id", "date_time", zip_key.alias("_zip")), ["_zip"]
    if hot is not None:
        keyed, dim = salted(keyed, "_zip", hot, ["product_id", "date_time"]), copied(dim, "_zip", hot)
        on = ["_zip", "_salt"]
    joined = keyed.join(dim, on, "left")
    return joined.select(
        "product_id",
        F.coalesce(F.col("state"), F.lit(UNKNOWN_STATE)).alias("state"),
        "date_time",
    )
