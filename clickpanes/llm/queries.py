"""One registered query per operator, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, language, mixing, negatives, preference, quality, repair, secret_scan, simhash, substring, toxicity, vectors
from .common import checkpointed


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return rows.withColumnRenamed("id", "doc_id")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rows = language.predict(docs.select("doc_id", "text"), language.train(docs))
    return rows.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "language.*")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_groups(_table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), "component_id")


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring.remove_repeats(_table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", secret_scan.secret_spans(docs).alias("found"))
    base = ["assign", "access", "hex"]
    return rows.select(
        "doc_id",
        *[secret_scan.count_kind(F.col("found"), k).alias(f"n_{k}") for k in base],
        F.sha2(secret_scan.span_list(F.col("found"), base), 256).alias("base_sha256"),
        secret_scan.span_list(F.col("found")).alias("spans"),
    )


def op7_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.json"))
    docs = bpe.round_trip_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer)
    return docs.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(_table(spark, sf_dir, "documents"))
    first = F.get("positions", F.lit(0))
    rows = rows.select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.size("positions") * F.col("size")).alias("taken"),
        first.alias("first_position"),
    )
    return checkpointed(rows).orderBy("first_position", "doc_id")


def op10_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = preference.turns(_table(spark, sf_dir, "conversations"))
    return preference.stale_reply_segments(conv).withColumnRenamed("pair", "conv_id")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), toxicity.toxicity(docs, model).alias("t"))
    predicted = (F.col("t.score") >= 0.5).cast("int").alias("predicted")
    return rows.select("doc_id", "held_out", "t.score", predicted, F.col("t.passages").alias("passages"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.vector_rows(table.select("vec_id", "embedding", moved.alias("label")))
    return negatives.hard_negatives(rows, rows.where("id % 100 = 0"))


def damaged(conv: DataFrame) -> DataFrame:
    """``conversations`` with faults put in by a checksum of ``conv_id:turn`` (nulls are one space)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conv.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    said = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), said.alias("text"), times.alias("time")).drop("time")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "conversations")
    rows = repair.summaries(repair.repair(damaged(table)))
    ids = table.select("conv_id").distinct()
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in repair.COUNTS]
    audit = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")]
    return ids.join(rows, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select("conv_id", *counts, *audit)


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_quality": op2_quality,
    "op3_language": op3_language,
    "op4_simhash": op4_simhash,
    "op5_substring": op5_substring,
    "op6_secrets": op6_secrets,
    "op7_vectors": op7_vectors,
    "op8_bpe": op8_bpe,
    "op9_mix_sources": op9_mix_sources,
    "op10_preference": op10_preference,
    "op11_toxicity": op11_toxicity,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_conversation_repair": op13_conversation_repair,
}
