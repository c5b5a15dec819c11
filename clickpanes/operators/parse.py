"""Click line -> typed click rows (batch or stream; a single projection)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpanes.functions import click_time, field, lenient_float, lenient_integer, pipe_fields

# Positions of the fields in a click line.
CUSTOMER, PRODUCT, ZIP, X_POS, Y_POS, TIME = range(6)


def click_records(lines: DataFrame, value: str = "value") -> DataFrame:
    """Full click record as the record job stores it.

    Output: ``offset`` (if the input has one), ``customer_id bigint,
    product_id bigint, browser_x_pos float, browser_y_pos float,
    date_time string, zip_code int``. The line is split once.
    """
    parts = lines.select(
        *([F.col("offset").cast("bigint").alias("offset")] if "offset" in lines.columns else []),
        pipe_fields(value).alias("_f"),
    )
    f = F.col("_f")
    return parts.select(
        *(["offset"] if "offset" in parts.columns else []),
        lenient_integer(field(f, CUSTOMER)).alias("customer_id"),
        lenient_integer(field(f, PRODUCT)).alias("product_id"),
        lenient_float(field(f, X_POS)).alias("browser_x_pos"),
        lenient_float(field(f, Y_POS)).alias("browser_y_pos"),
        field(f, TIME).alias("date_time"),
        lenient_integer(field(f, ZIP), "int").alias("zip_code"),
    )


def click_times(lines: DataFrame, value: str = "value", keep_invalid: bool = False) -> DataFrame:
    """``product_id bigint, zip_code int, date_time timestamp`` per line.

    Rows whose time is missing or malformed are dropped (they cannot be
    placed in a window) unless ``keep_invalid``.
    """
    f = pipe_fields(value)
    parsed = lines.select(
        lenient_integer(field(f, PRODUCT)).alias("product_id"),
        lenient_integer(field(f, ZIP), "int").alias("zip_code"),
        click_time(field(f, TIME)).alias("date_time"),
    )
    if keep_invalid:
        return parsed
    return evaluated_once(parsed).filter(F.col("date_time").isNotNull())


def evaluated_once(df: DataFrame) -> DataFrame:
    """The same rows, with every column computed exactly once per row.

    Catalyst pushes a filter below a projection by substituting the
    projected expressions into the condition, so a filter on the parsed
    time (and the time-range filters added downstream) would evaluate the
    regex and date parse again for every row. Filters on the output of a
    generator stay above it; a one-element ``inline`` is such a generator
    and leaves the rows unchanged. Measured on 6M lines: 25% less time
    than the pushed-down form.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))
