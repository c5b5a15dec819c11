"""Mixing sources to target weights by a time-varying curriculum.

Training time runs from 0 to 1. Source ``i`` with ``n`` words and target ``g``
has the linear weight schedule ``w(t) = g + k (n - g)(1 - 2t)``: it starts near
the natural share and ends beyond the target, and its integral over [0, 1] is
the target. ``k`` is the largest value up to 1 that keeps every schedule at or
above zero, so the schedules add up to the same total at any time. The
integral ``D(t)`` is the source's cumulative demand; a document copy whose middle
word stands at offset ``u`` of the source's stream is trained at ``D^-1(u)``,
a closed form. Documents are range-sorted by that position.

A source's stream is its documents in the order of a hash of id and text, repeated
up to ``max_repeats`` times. Offsets are prefix sums in three levels (rows of a
bin, bins of a block, blocks of a source), so a source that holds most rows is
spread over its bins. Rows equal in id and text share a hash; a bin
they overfill is cut by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, checkpointed, column, fresh

ROWS_PER_BIN = 256
FULL_BIN = 16  # times the rows of a bin that chance does not fill it with
CUT_BITS = 12  # rows of an overfull bin's part
BINS_PER_BLOCK = 4096
HASH_BITS = 60


def _order_hash(id_: Column, text: Column) -> Column:
    """A 60-bit number from the md5 of id and text (the same in any engine)."""
    text = F.concat(F.lit("mix:"), F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), F.md5(text))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """``no_source, source, source_size, target, bend``, one row per source.

    ``sizes`` has ``no_source, source, size``. Sources by code point, null last,
    weigh ``weights`` in turn and share all words; a target stops at
    ``max_repeats`` times its source, and what is above goes to the others by weight.
    That fixed point is found in one pass over the sources by ``limit / weight``.
    ``bend`` is ``k (n - g)`` of the schedule. One row per source meets in one
    task, never one per document: sources are meant to be a list that fits there (up to about a million).
    """
    total = sizes.groupBy("no_source", "source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy("no_source", "source")) - 1
    cycle = F.array(*[F.lit(w) for w in weights])
    total = total.withColumn("weight", F.get(cycle, rank % len(weights)))
    total = total.withColumn("most", F.col("source_size") * max_repeats)
    by_limit = Window.orderBy(F.col("most") / F.col("weight"), "no_source", "source")
    before, after = by_limit.rowsBetween(Window.unboundedPreceding, -1), by_limit.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("most").over(before), F.lit(0))
    total = total.withColumn("level", left / F.sum("weight").over(after))
    total = total.withColumn("full", F.col("most") / F.col("weight") <= F.col("level"))
    total = total.withColumn("level", F.max(F.when(~F.col("full"), F.col("level"))).over(Window.partitionBy()))
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(F.col("level") * F.col("weight"))
    total = total.withColumn("target", target)
    gap = F.col("source_size") - F.col("target")
    room = F.when(gap != 0, F.col("target") / F.abs(gap))
    k = F.least(F.lit(1.0), F.coalesce(F.min(room).over(Window.partitionBy()), F.lit(1.0)))
    return total.select("no_source", "source", "source_size", "target", (k * gap).alias("bend"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (1, 2, 3),
    max_repeats: int = 3,
) -> DataFrame:
    """``id, text_hash, size, source_size, target, positions``, one row per input row.

    ``size`` counts words (null text: 0); ``positions`` holds the training time
    of every copy taken, in order, none to ``max_repeats``. A copy is taken
    whole, if its middle word lies before the source's target. Rows that repeat
    an id are documents of their own; rows equal in id and text are
    interchangeable. Documents without words are never taken. The result
    depends on the rows only, not on their order or partitions; an empty table
    gives an empty result.
    """
    return _plan(docs, id_col, text_col, source_col, weights, max_repeats).drop("row")


def _plan(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: Sequence[int], max_repeats: int) -> DataFrame:
    """``mix``, with the input row's ``monotonically_increasing_id`` as ``row``."""
    source = column(docs, source_col).cast("string")
    text = F.coalesce(column(docs, text_col).cast("string"), F.lit(""))
    rows = docs.select(
        column(docs, id_col).alias("id"),
        F.xxhash64(column(docs, text_col)).alias("text_hash"),
        source.isNull().alias("no_source"),
        F.coalesce(source, F.lit("")).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        _order_hash(column(docs, id_col), text).alias("turn"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = checkpointed(rows)
    bins = rows.count() // ROWS_PER_BIN + 1
    width = (1 << HASH_BITS) // bins + 1
    rows = rows.withColumn("bin", F.expr(f"turn div {width}L"))
    src = ["no_source", "source"]
    # A bin overfilled by rows equal in id and text is cut by hash and row: the order stays.
    full = rows.groupBy(*src, "bin").agg(F.count("*").alias("rows")).where(F.col("rows") > FULL_BIN * ROWS_PER_BIN)
    rows = rows.join(full.select(*src, "bin", F.lit(True).alias("full")), [*src, "bin"], "left")
    cut = lambda c: F.when(F.col("full"), c).otherwise(F.lit(-1).cast("long"))
    rows = rows.withColumns({"part": cut(F.col("turn")), "sub": cut(F.shiftright("row", CUT_BITS))}).drop("full")
    place = ["bin", "part", "sub"]
    per_bin = rows.groupBy(*src, *place).agg(F.sum("size").alias("words"))
    per_bin = checkpointed(per_bin.withColumn("block", F.expr(f"bin div {BINS_PER_BLOCK}L")))
    per_block = per_bin.groupBy(*src, "block").agg(F.sum("words").alias("words"))

    def start(words: str, part: list[str], *order: str) -> Column:
        over = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(words).over(over), F.lit(0))

    targets = source_targets(per_block.withColumnRenamed("words", "size"), weights, max_repeats)
    blocks = per_block.withColumn("block_start", start("words", src, "block")).drop("words")
    blocks = blocks.join(targets, src)
    at_bin = per_bin.withColumn("bin_start", start("words", [*src, "block"], *place)).drop("words")
    at_bin = at_bin.join(blocks, [*src, "block"])
    at_bin = at_bin.withColumn("bin_start", F.col("bin_start") + F.col("block_start"))
    at_bin = at_bin.drop("block", "block_start")
    rows = rows.withColumn("start", start("size", [*src, *place], "turn", "id", "size", "text_hash", "row"))
    rows = rows.join(at_bin, [*src, *place])
    middle = F.col("bin_start") + F.col("start") + F.col("size") / 2
    line = F.col("target") + F.col("bend")

    def position(turn: int) -> Column:
        at = middle + turn * F.col("source_size")
        root = F.sqrt(F.greatest(F.lit(0.0), line * line - 4 * F.col("bend") * at))
        return F.when((F.col("size") > 0) & (at < F.col("target")), 2 * at / (line + root))

    return rows.select(
        "id",
        "row",
        "text_hash",
        "size",
        "source_size",
        "target",
        F.array_compact(F.array(*[position(j) for j in range(max_repeats)])).alias("positions"),
    )


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (1, 2, 3),
    max_repeats: int = 3,
) -> DataFrame:
    """The rows of ``docs``, one for every copy taken, range-sorted by training
    position, with the columns of ``docs``.

    Documents meet their positions by row number, so ``docs`` has to give the same rows in the
    same partitions whenever it is read, as a stored table or a checkpointed DataFrame does. Null, empty and
    repeated rows are treated as in ``mix``; an empty table gives an empty one."""
    r, p = fresh(docs, "mix_row", "mix_position")
    plan = _plan(docs, id_col, text_col, source_col, weights, max_repeats).where(F.size("positions") > 0)
    plan = plan.select(F.col("row").alias(r + "k"), F.col("positions").alias(p))
    keyed = docs.withColumn(r, F.monotonically_increasing_id())
    copies = keyed.join(plan, F.col(r) == F.col(r + "k")).withColumn(p, F.explode(p))
    return copies.repartitionByRange(p, r).sortWithinPartitions(p, r).select(*[column(copies, c) for c in docs.columns])
