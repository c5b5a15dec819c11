"""Repeatable key sampling and bucketing.

A key's bucket depends only on the key (md5 of its text), so a sample
keeps every row of a chosen key and per-key aggregates stay exact; the
same keys are chosen in every run and by any engine with md5.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpanes.functions.sampling import stable_bucket


def with_key_bucket(df: DataFrame, key: str, buckets: int, name: str = "bucket") -> DataFrame:
    return df.withColumn(name, stable_bucket(key, buckets))


def sample_keys(df: DataFrame, key: str, keep: int, buckets: int) -> DataFrame:
    """Rows of the keys in the first ``keep`` of ``buckets`` buckets
    (about ``keep / buckets`` of the keys)."""
    return df.filter(stable_bucket(key, buckets) < keep)


def bucket_totals(views: DataFrame, buckets: int) -> DataFrame:
    """Per product bucket: views and distinct products (a sample's size).

    Views are summed per product first, so a bucket is worked out once per product, and
    products are counted without a distinct aggregation."""
    products = views.groupBy("product_id").agg(F.sum("count").alias("no_views"))
    return products.groupBy(stable_bucket("product_id", buckets).alias("bucket")).agg(
        F.sum("no_views").cast("bigint").alias("no_views"),
        F.count("product_id").alias("products"),
    )
