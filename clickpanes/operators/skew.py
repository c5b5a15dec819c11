"""Keys that hold a large share of the rows, found by a mergeable sketch.

``key_sketch`` counts frequent keys in one pass (Spark's frequent-items sketch, merged map-side), and
sketches of several batches or recordings are merged, so what is hot is known from what has been recorded
and no batch is read twice. Only hot keys are salted in a join, and only their rows
of the other side are copied.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bounds of Spark's sketch, and salts for every mean task's worth of rows of a key.
LEAST_TRACKED, MOST_TRACKED = 1_000, 1_000_000
SALTS_PER_TASK = 16


def key_sketch(df: DataFrame, key: str) -> DataFrame:
    """One row ``rows, sketch`` of a key column (whole numbers). NULL keys match nothing and are left out."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tracked = min(max(8 * n, LEAST_TRACKED), MOST_TRACKED)
    keys = df.select(F.col(key).cast("bigint").alias("k")).where("k IS NOT NULL")
    return keys.agg(F.count("*").alias("rows"), F.expr(f"approx_top_k_accumulate(k, {tracked})").alias("sketch"))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One row from the rows of several ``key_sketch`` results."""
    return sketches.agg(F.sum("rows").alias("rows"), F.expr("approx_top_k_combine(sketch)").alias("sketch"))


def hot_keys(sketch: DataFrame, partitions: int | None = None) -> DataFrame:
    """``key bigint, salts int``: the keys with more rows than a mean task's, and over how many salts to deal each.

    At most ``partitions`` keys can have such a share, and their salts are at most ``SALTS_PER_TASK + 1``
    times as many, so the table is collected and is a small local one from then on (a stream plans it anew in every
    batch). ``partitions`` defaults to ``spark.sql.shuffle.partitions``."""
    spark: SparkSession = sketch.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    each = sketch.select("rows", F.explode(F.expr(f"approx_top_k_estimate(sketch, {n})")).alias("e"))
    share = F.col("e.count") / F.col("rows")
    hot = each.where((share > 1 / n) & F.col("e.item").isNotNull())
    rows = hot.select(F.col("e.item").alias("key"), F.ceil(share * (n * SALTS_PER_TASK)).cast("int").alias("salts")).collect()
    return spark.createDataFrame([tuple(r) for r in rows], "key bigint, salts int")


def salted(df: DataFrame, key: str, hot: DataFrame, by: list[str], name: str = "_salt") -> DataFrame:
    """Rows with a salt: a hash of ``by`` below the number of salts of a hot key, 0 for any other key."""
    known = df.join(F.broadcast(hot.select(F.col("key").alias("_hot"), F.col("salts").alias("_salts"))), F.col(key) == F.col("_hot"), "left")
    salt = F.coalesce(F.pmod(F.xxhash64(*by), F.col("_salts")), F.lit(0)).cast("int")
    return known.withColumn(name, salt).drop("_hot", "_salts")


def copied(df: DataFrame, key: str, hot: DataFrame, name: str = "_salt") -> DataFrame:
    """Rows of the other side: one for each salt of a hot key, one for any other key."""
    known = df.join(F.broadcast(hot.select(F.col("key").alias("_hot"), F.col("salts").alias("_salts"))), F.col(key) == F.col("_hot"), "left")
    salts = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    return known.withColumn(name, F.explode(salts)).drop("_hot", "_salts")
