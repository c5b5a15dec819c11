"""Repeatable per-key numbers for key sampling and bucketing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_bucket(key: Column | str, buckets: int) -> Column:
    """Bucket ``0..buckets-1`` from the first 32 bits of ``md5(key)``.

    Same value in every run and on every engine that has md5, unlike
    ``rand()``; DuckDB: ``('0x' || substr(md5(k), 1, 8))::bigint % n``.
    """
    key = F.col(key) if isinstance(key, str) else key
    head = F.substring(F.md5(key.cast("string")), 1, 8)
    return (F.conv(head, 16, 10).cast("bigint") % F.lit(buckets)).cast("int")
