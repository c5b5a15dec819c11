"""File sources with explicit schemas (no inference pass over the data)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpanes import schemas
from clickpanes.store import read_store


def read_zip_states(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``zip_code, state`` from a Parquet table or a CSV file with header."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt == "csv":
        df = spark.read.schema(schemas.ZIP_STATE_CSV).option("header", True).option(
            "sep", ","
        ).csv(path)
    else:
        raise ValueError(f"unsupported zip-state format: {fmt}")
    return df.select(
        F.col("zip_code").cast("int").alias("zip_code"),
        F.col("state").cast("string").alias("state"),
    )


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PRODUCT).json(path)


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CATEGORY).json(path)


def read_departments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DEPARTMENT).json(path)


def read_views(spark: SparkSession, path: str) -> DataFrame:
    """Product views stored by ``hour``; predicates on ``hour`` prune
    partition directories before any file is opened. Of a store with a commit log
    only committed runs are read."""
    return read_store(spark, path, schemas.PRODUCT_VIEWS)


def text_lines_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Streaming ``value`` lines from text files appearing under ``path``."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def rows(spark: SparkSession, data: Iterable, ddl: str) -> DataFrame:
    """Small in-memory table with a DDL schema (fixtures, parameters)."""
    return spark.createDataFrame(list(data), schema=ddl)


def dev_zip_states(spark: SparkSession, low: int = 10000, high: int = 100000) -> DataFrame:
    """Test-mode dimension: ``State <zip>`` for every zip in ``[low, high)``,
    generated on the executors rather than shipped from the driver."""
    return spark.range(low, high).select(
        F.col("id").cast("int").alias("zip_code"),
        F.concat(F.lit("State "), F.col("id").cast("string")).alias("state"),
    )
