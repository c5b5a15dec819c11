"""Quality by importance resampling.

Two generative models over hashed word unigrams and bigrams: one of target text
(documents labelled good), one of all raw text. A document's log importance weight is
the sum over its n-grams of ``log p_target - log p_raw``. Documents are
resampled without replacement by Gumbel top-k: ``log weight + Gumbel noise`` of
a hash of id and text, the ``k`` largest stay.

The raw model counts all documents, whole. The target model is fitted on at
most about ``target_rows`` labelled documents (a hash sample where there are
more), whose ids are broadcast; so no text is shuffled. Each partition adds up
its own counts, and ``buckets`` sums come to the driver. ``k`` is the share of
good labels times the number of documents, unless given.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, column
from .wordhash import gram_hashes, word_hashes

BUCKETS = 1 << 14
TARGET_ROWS = 50_000
BINS = 1024
EXACT_ROWS = 10_000
HASH_STEPS = 1 << 52


def buckets_of(text: str | None, buckets: int) -> np.ndarray:
    """The bucket of every word and word pair of a text (A-Z in lower case)."""
    words = word_hashes((text or "").encode("utf-8", "replace").lower())
    return (np.concatenate([words, gram_hashes(words, 2)]) % np.uint64(buckets)).astype(np.int64)


def _counter(buckets: int):
    """Task: rows (text, target) to one row (bucket, raw, target) per bucket met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for text, target in zip(batch.column(0), batch.column(1).to_pylist()):
                found = np.bincount(buckets_of(text.as_py(), buckets), minlength=buckets)
                raw += found
                if target:
                    good += found
        met = np.flatnonzero(raw)
        columns = [pa.array(met), pa.array(raw[met]), pa.array(good[met])]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "raw", "good"])

    return run


def good_ids(labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality") -> DataFrame:
    """``id, good``, one row per labelled id; of several labels the best counts."""
    rows = labels.select(column(labels, id_col).alias("id"), column(labels, quality_col).alias("q"))
    return rows.where("id IS NOT NULL AND q IS NOT NULL").groupBy("id").agg((F.max("q") > 0).alias("good"))


def log_ratios(docs: DataFrame, good: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, target_rows: int = TARGET_ROWS) -> np.ndarray:
    """``log p_target - log p_raw`` by bucket, with one count added to each."""
    n = good.count()
    if n > target_rows:
        turn = F.pmod(F.xxhash64(F.lit("target"), "id"), F.lit(1 << 30))
        good = good.where(turn < int((1 << 30) * target_rows / n))
    ids = good.select("id", F.lit(True).alias("hit"))
    rows = docs.select(column(docs, id_col).alias("id"), column(docs, text_col).cast("string").alias("text"))
    # About target_rows ids at most (a hash sample of that size).
    marked = rows.join(F.broadcast(ids), "id", "left").select("text", F.coalesce("hit", F.lit(False)).alias("target"))
    counts = marked.mapInArrow(_counter(buckets), "bucket long, raw long, good long")
    sums = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).toArrow()
    raw, target = np.ones(buckets), np.ones(buckets)
    at = sums["bucket"].to_numpy()
    raw[at] += sums["raw"].to_numpy()
    target[at] += sums["good"].to_numpy()
    if not sums.num_rows or not sums["good"].to_numpy().any():
        return np.zeros(buckets)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weigh(docs: DataFrame, ratios: np.ndarray, text_col: str = "text"):
    """A column: the log importance weight of each text (null or blank: 0)."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = shared.value
        for texts in columns:
            yield pa.array([float(table[buckets_of(t.as_py(), len(table))].sum()) for t in texts], pa.float64())

    return F.arrow_udf(run, T.DoubleType())(column(docs, text_col).cast("string"))


def top_k_bound(rows: DataFrame, key: str, k: int) -> float | None:
    """The k-th largest value of ``key``, exactly: histograms that narrow to
    the bin it is in, until that holds few rows; None for no row at all.
    ``BINS`` counts a round, and ``EXACT_ROWS`` values at the end, come to the driver."""
    low, high, total = rows.agg(F.min(key), F.max(key), F.count(key)).first()
    if not total or k <= 0:
        return None
    above = 0  # rows above the present range
    inside, k = total, min(k, total)
    while inside > EXACT_ROWS and low < high:
        width = (high - low) / BINS
        if low + width <= low:
            break
        at = F.least(F.floor((F.col(key) - F.lit(low)) / F.lit(width)), F.lit(BINS - 1)).cast("int")
        held = rows.where(F.col(key).between(low, high)).groupBy(at.alias("bin"))
        counts = held.agg(F.count("*"), F.min(key), F.max(key)).collect()
        for _, n, least, most in sorted(counts, reverse=True):
            if above + n >= k:
                low, high, inside = least, most, n
                break
            above += n
    if inside <= EXACT_ROWS:
        values = sorted((r[0] for r in rows.where(F.col(key).between(low, high)).select(key).collect()), reverse=True)
        return values[k - above - 1]
    return low


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality", k: int | None = None, seed: int = 0, **options) -> DataFrame:
    """``id, log_weight, key, kept``, one row per input row.

    ``kept``: among the ``k`` largest keys (rows that tie with the last stay
    too). Without any good label all weights are 0; without any label all
    rows stay. Null and blank texts weigh 0. Different rows have noise of their own, also where
    they share an id or have none; rows equal in id and text are drawn together. Other columns are not read; an
    empty table gives no rows.
    """
    good = checkpointed(good_ids(labels, id_col, quality_col))
    ratios = log_ratios(docs, good.where("good"), id_col, text_col, **options)
    own = [F.coalesce(column(docs, c).cast("string"), F.lit("")) for c in (id_col, text_col)]
    turn = F.pmod(F.xxhash64(F.lit(seed), *own), F.lit(HASH_STEPS))
    uniform = (turn + 0.5) / HASH_STEPS
    rows = docs.select(column(docs, id_col).alias("id"), weigh(docs, ratios, text_col).alias("log_weight"), (-F.log(-F.log(uniform))).alias("noise"))
    rows = checkpointed(rows.select("id", "log_weight", (F.col("log_weight") + F.col("noise")).alias("key")))
    if k is None:
        n, share = good.agg(F.count("*"), F.avg(F.col("good").cast("int"))).first()
        k = round(rows.count() * share) if n else rows.count()
    bound = top_k_bound(rows, "key", k)
    kept = F.lit(False) if bound is None else F.col("key") >= F.lit(bound)
    return rows.select("id", "log_weight", "key", kept.alias("kept"))
