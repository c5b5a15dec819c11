"""The corpus pipeline: stages over ``documents``, each by one operator.

Every stage works on all its predecessor kept, and its decisions take effect. ``run``
writes each stage's documents as Parquet below ``spark.checkpoint.dir`` and
reads them again for the next; what a stage no longer needs is deleted.

Rows without an id are documents like any other. A null text has no letter, so it goes in the first stage;
an empty one too. Of rows that repeat a text one stays in the second. An empty table stays empty
through all stages, and columns beside those of ``documents`` are carried along, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpanes.llm import bpe, exact_dedup, language, mixing, simhash
from clickpanes.llm.common import checkpoint_dir, delete_path


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified: those without a letter, and
    those no learned language explains with a score of 0.5, go."""
    return language.identified(docs)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of every group of near copies."""
    return simhash.drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for every copy the mix takes, range-sorted by training position."""
    return mixing.mixed_documents(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids; ``text`` is decoded from them again.
    Columns beside those of ``documents``: ``ids`` (packed little-endian unsigned 32-bit
    integers) and ``n_tokens``; they replace columns of these names."""
    import public_tokenizers

    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.json"))
    coded = bpe.round_trip_documents(docs, tokenizer, to="text")
    return coded.withColumn("n_tokens", F.expr("octet_length(ids) div 4"))


STAGES = [
    ("language ID", language_stage),
    ("exact dedup", exact_dedup_stage),
    ("SimHash near-dedup", simhash_stage),
    ("mixing", mixing_stage),
    ("BPE", bpe_stage),
]

#: Context trees, XXH64 and BPE have no functions in SQL; tests hold the rows
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    base, before = f"{checkpoint_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex[:12]}", None
    for k, (_, stage) in enumerate(STAGES[:-1]):
        path = f"{base}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
