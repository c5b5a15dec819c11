"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters between words, as a Java regular expression (fixed value).
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary
    folder only where that is unset on a one-machine ``local`` master."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            shared = tempfile.mkdtemp(prefix="clickpanes-llm-")
        sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that Spark wrote, on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder now and cut its lineage;
    lost executors do not lose it, and it is computed once."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def column(df: DataFrame, name: str) -> Column:
    return df["`" + name.replace("`", "``") + "`"]


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose (id, text) is in ``kept``, with all columns.

    ``kept`` holds ``id`` and ``text_hash = xxhash64(text)``. Rows that repeat
    both id and text are one document: the smallest by the other columns stays.
    """
    i, h, n = fresh(docs, "keep_id", "keep_hash", "keep_row")
    kinds = (T.MapType, T.VariantType)
    order = [
        column(docs, f.name)
        for f in docs.schema.fields
        if f.name not in (id_col, text_col) and not isinstance(f.dataType, kinds)
    ]
    wanted = kept.select(F.col("id").alias(i + "k"), F.col("text_hash").alias(h + "k")).distinct()
    keyed = docs.withColumns({i: column(docs, id_col), h: F.xxhash64(column(docs, text_col))})
    hit = keyed.join(
        wanted, F.col(i).eqNullSafe(F.col(i + "k")) & (F.col(h) == F.col(h + "k")), "left_semi"
    )
    first = F.row_number().over(Window.partitionBy(i, h).orderBy(*(order or [F.col(i)])))
    return hit.withColumn(n, first).where(F.col(n) == 1).drop(i, h, n)


def components(edges: DataFrame) -> DataFrame:
    """``v, root``: every vertex of ``edges`` (longs ``a``, ``b``) with the
    smallest vertex it can reach.

    Large-star and small-star rounds on the edge table; each round is two
    joins on the vertex (AQE splits the partition of a vertex with many edges)
    and is written to the checkpoint folder. It ends when a round changes
    nothing; only a count and a checksum come to the driver.
    """
    far, near = F.greatest("a", "b"), F.least("a", "b")
    now = edges.where("a <> b").select(far.alias("u"), near.alias("v")).distinct()
    now, seen = checkpointed(now), None
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            return now.select(F.col("u").alias("v"), F.col("v").alias("root")).union(
                now.select("v", F.col("v").alias("root")).distinct()
            )
        seen = state
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = checkpointed(large.distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v"), F.col("m"))
        small = small.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        now = checkpointed(small.union(low.select("u", F.col("m").alias("v"))).distinct())
