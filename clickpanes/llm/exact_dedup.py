"""Exact deduplication: a tree merge of sorted digest runs (built-in functions only).

Every input partition makes one run: its distinct text digests, sorted (the
aggregate of a struct is Spark's sort aggregate), each with the row it would
keep and its number of rows. In each round ``FAN_IN`` neighbouring runs (four
binomial rounds at once) are merged into one, a digest at a time, until one run
is left. A round is hash-partitioned by run and digest, so no task holds a whole
run, and a digest that fills the table enters a round at most ``FAN_IN`` times
per merged run. The decisions go back down the same tree: each level joins its
parent by (run, digest), so the rows of a digest that repeats often are spread
over its runs at every step.

A digest is verified on every level by two witnesses that travel with it, the
length of the normalised text and its 64-bit XXH64: rows merge only where all
three agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, checkpointed, column, keep_rows

FAN_IN = 16
KEY = ["digest", "n_norm", "witness"]


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text_hash, n_points, digest, n_norm, witness, run, rid``, one row per input row."""
    text = F.coalesce(column(docs, text_col).cast("string"), F.lit(""))
    rows = docs.select(
        column(docs, id_col).alias("id"),
        F.xxhash64(column(docs, text_col)).alias("text_hash"),
        F.length(text).cast("long").alias("n_points"),
        F.regexp_replace(text, SPACE, "").alias("norm"),
    )
    return rows.select(
        "id",
        "text_hash",
        "n_points",
        F.unhex(F.sha2("norm", 256)).alias("digest"),
        F.length("norm").alias("n_norm"),
        F.xxhash64("norm").alias("witness"),
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("rid"),
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text_hash, keep_id, group_size, kept, text_sha256``, one row per input row.

    Texts are equal when equal without the characters of ``SPACE``; a null text
    counts as empty. Of equal texts the row with the most code points stays,
    then the smallest id (null last), then the first of repeated rows: exactly
    one row of a group is ``kept``. An empty table gives an empty result; other
    columns of ``docs`` are not read.
    """
    # The tree needs run numbers that stay: the thin table is written once.
    rows = checkpointed(digests(docs, id_col, text_col))
    best = F.struct(
        (-F.col("n_points")).alias("longest"),
        F.col("id").isNull().alias("no_id"),
        F.col("id").alias("id"),
        F.col("rid").alias("rid"),
    )
    run = rows.groupBy("run", *KEY).agg(F.min(best).alias("best"), F.count("*").alias("n"))
    levels = [checkpointed(run)]
    last = rows.agg(F.max("run")).first()[0] or 0
    while last:
        merged = levels[-1].withColumn("run", F.shiftright("run", 4))
        merged = merged.groupBy("run", *KEY).agg(F.min("best").alias("best"), F.sum("n").alias("n"))
        levels.append(checkpointed(merged))
        last //= FAN_IN
    keep = levels[-1].select("run", *KEY, "best", "n")
    for level in reversed(levels[:-1]):
        up = keep.withColumnRenamed("run", "parent")
        below = level.select("run", *KEY).withColumn("parent", F.shiftright("run", 4))
        keep = below.join(up, ["parent", *KEY]).drop("parent")
    return rows.join(keep, ["run", *KEY]).select(
        "id",
        "text_hash",
        F.col("best.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("rid") == F.col("best.rid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of every group of equal texts, all columns kept."""
    kept = exact_groups(docs, id_col, text_col).where("kept")
    return keep_rows(docs, kept, id_col, text_col)
