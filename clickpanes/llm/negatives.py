"""Hard-negative mining by a secondary-sort shuffle.

Anchors are compared with all rows in blocks: rows are packed, where they lie, into
tiles of up to ``TILE`` vectors, anchors into tiles of up to ``ANCHOR_TILE``, and every pair of
tiles is one product of matrices. (The anchors are a stated query set; pairs of tiles meet by
an equality join on the anchor tile and a salt, no cross join.)

Two rounds keep the shuffle far below all pairs, and exact. The first sends each
tile's ``positives`` best rows of an anchor's label, of which the best of all tiles are the
anchor's positives. Their scores bound the windows a negative can lie in, so in the second
round a tile sends only its first ``negatives`` rows of each window: a row behind
them in its own tile cannot be among the first of all.

What is sent is keyed by (anchor, descending score, id), dealt by anchor and sorted
by key (``repartitionAndSortWithinPartitions``, which spills). One pass over a partition then
meets an anchor's rows in descending score: a row of its label opens a window, a row of
another label is emitted into every open window that has room. It holds one
counter per window, never an anchor's rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.rdd import portable_hash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, column

TILE = 4096
ANCHOR_TILE = 1024
LONG = (1 << 63) - 1


def vector_rows(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256) -> DataFrame:
    """``row, id, label, q`` of the rows that take part; ``q`` holds ``floor(scale * x)`` as bytes of longs.

    Rows with a null label, a null vector, or a null or non-finite component take no part.
    Components are bounded by plus and minus 2^62. ``row`` tells rows apart that are equal in all columns."""
    v = F.transform(column(df, vector_col), lambda x: x.cast("double"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(column(df, id_col).cast("long").alias("id"), column(df, label_col).alias("label"), v.alias("v"), bad.alias("bad"))
    rows = rows.where("label IS NOT NULL AND v IS NOT NULL AND NOT bad").select("id", "label", "v", F.monotonically_increasing_id().alias("row"))

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, at = batch.column(2), 0
            flat = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False))
            flat = np.clip(flat, -(2.0**62), 2.0**62).astype("<i8")
            packed = []
            for n in np.diff(lists.offsets.to_numpy()):
                packed.append(flat[at : at + n].tobytes())
                at += n
            yield pa.RecordBatch.from_arrays([batch.column(3), batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["row", "id", "label", "q"])

    kind = rows.schema["label"].dataType.simpleString()
    return checkpointed(rows.mapInArrow(quantise, f"row long, id long, label {kind}, q binary"))


def _tiles(rows: DataFrame, size: int, extra: list[str] = []) -> DataFrame:  # noqa: B006
    """One row per tile of up to ``size`` rows of equal dimension: ``dim, n`` and the columns as arrays, ``q`` as one matrix."""
    names = ["row", "id", "label", *extra]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[dict]] = {}

        def out(dim: int, group: list[dict]) -> pa.RecordBatch:
            table = {"dim": dim, "n": len(group), "q": b"".join(r["q"] for r in group)} | {c: [r[c] for r in group] for c in names}
            return pa.RecordBatch.from_pylist([table], schema)

        schema = None
        for batch in batches:
            if schema is None:
                fields = [("dim", pa.int32()), ("n", pa.int32()), ("q", pa.binary())]
                schema = pa.schema(fields + [(c, pa.list_(batch.schema.field(c).type)) for c in names])
            for r in batch.to_pylist():
                group = held.setdefault(len(r["q"]) // 8, [])
                group.append(r)
                if len(group) == size:
                    yield out(len(r["q"]) // 8, group)
                    group.clear()
        for dim, group in held.items():
            if group:
                yield out(dim, group)

    arrays = ", ".join(f"{c} array<{kinds[c]}>" for c in names)
    return rows.select("q", *names).mapInArrow(pack, f"dim int, n int, q binary, {arrays}")


def _scores(a: dict, b: dict) -> np.ndarray:
    """Inner products of the vectors of two tiles: as doubles or longs where these are exact, else as Python integers held to the range of a long."""
    x, y = (np.frombuffer(t["q"], "<i8").reshape(t["n"], -1) for t in (a, b))
    if not x.shape[1]:
        return np.zeros((len(x), len(y)), np.int64)
    most = int(np.abs(x).max()) * int(np.abs(y).max()) * x.shape[1]
    if most < 1 << 53:
        return (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    if most <= LONG:
        return x @ y.T
    return np.clip(x.astype(object) @ y.astype(object).T, -LONG, LONG).astype(np.int64)


def _pairs(rows: DataFrame, anchors: DataFrame, extra: list[str] = []) -> DataFrame:  # noqa: B006
    """Every anchor tile beside every row tile of its dimension."""
    salts = rows.sparkSession.sparkContext.defaultParallelism * 2
    tiles = _tiles(rows, TILE)
    tiles = tiles.select(*tiles.columns, F.pmod(F.xxhash64(F.get("row", F.lit(0))), F.lit(salts)).alias("salt"))
    few = checkpointed(_tiles(anchors.repartition(max(1, -(-anchors.count() // ANCHOR_TILE))), ANCHOR_TILE, extra).select(F.struct("*").alias("a"), F.monotonically_increasing_id().alias("block")))
    copies = few.select("a", F.col("a.dim").alias("dim"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))
    return tiles.select(F.struct(*[c for c in tiles.columns if c != "salt"]).alias("b"), "dim", "salt").join(copies, ["dim", "salt"]).select("a", "b")


def _before(score: np.ndarray, ids: np.ndarray, none: np.ndarray) -> np.ndarray:
    """Order by descending score, then id, null last."""
    return np.lexsort((ids, none, -score))


def _columns(tile: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.array([0 if i is None else i for i in tile["id"]], np.int64)
    return np.array(tile["row"]), ids, np.array([i is None for i in tile["id"]])


def _same(a: dict, b: dict) -> np.ndarray:
    codes: dict = {}
    x, y = ([codes.setdefault(v, len(codes)) for v in t["label"]] for t in (a, b))
    return np.array(x)[:, None] == np.array(y)[None, :]


def _first_positives(k: int):
    """Task: pairs of tiles to each anchor's ``k`` best other rows of its label in the tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                a, b = pair["a"], pair["b"]
                score, same = _scores(a, b), _same(a, b)
                rows, ids, none = _columns(b)
                out = []
                for i, anchor in enumerate(a["row"]):
                    at = np.flatnonzero(same[i] & (rows != anchor))
                    at = at[_before(score[i, at], ids[at], none[at])[:k]]
                    out += [{"anchor": anchor, "anchor_id": a["id"][i], "id": b["id"][j], "score": int(score[i, j])} for j in at]
                yield pa.RecordBatch.from_pylist(out, pa.schema([("anchor", pa.int64()), ("anchor_id", pa.int64()), ("id", pa.int64()), ("score", pa.int64())]))

    return run


def in_window(positive: int, negative: int, low: int, high: int) -> bool:
    return low * positive <= 100 * negative <= high * positive


def _first_negatives(k: int, low: int, high: int):
    """Task: pairs of tiles to the first ``k`` rows of another label in each of an anchor's windows, each row once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                a, b = pair["a"], pair["b"]
                score, other = _scores(a, b), ~_same(a, b)
                _, ids, none = _columns(b)
                out = []
                for i, anchor in enumerate(a["row"]):
                    at = np.flatnonzero(other[i])
                    at = at[_before(score[i, at], ids[at], none[at])]
                    down, taken = -score[i, at], set()
                    for p in set(a["found"][i]):
                        # The whole numbers s with low * p <= 100 * s <= high * p.
                        first = np.searchsorted(down, -((high * p) // 100))
                        last = np.searchsorted(down, (-low * p) // 100, "right")
                        taken.update(at[first : min(first + k, last)].tolist())
                    out += [{"anchor": anchor, "anchor_id": a["id"][i], "id": b["id"][j], "score": int(score[i, j])} for j in taken]
                yield pa.RecordBatch.from_pylist(out, pa.schema([("anchor", pa.int64()), ("anchor_id", pa.int64()), ("id", pa.int64()), ("score", pa.int64())]))

    return run


def _emit(rows: Iterator, negatives: int, low: int, high: int) -> Iterator[tuple]:
    """Rows of a partition in the order of their keys ``(anchor, -score, is negative, id is null, id)`` to mined rows.

    A negative of a window never comes before its positive: at equal scores positives
    are first, and a score above the positive's is in no window."""
    anchor, windows = None, []
    for (at, down, negative, none, id_), anchor_id in rows:
        if at != anchor:
            anchor, windows = at, []
        score, id_ = -down, None if none else id_
        if not negative:
            windows.append([id_, score, 0])
            continue
        for w in windows:
            if w[2] < negatives and in_window(w[1], score, low, high):
                w[2] += 1
                yield anchor_id, w[0], w[2], id_, w[1], score


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """``RESULT``: for each anchor and each of its first ``positives`` other rows of its label, the first
    ``negatives`` rows of another label whose score lies from ``low`` to ``high`` percent of the positive's.

    ``rows`` comes from ``vector_rows``, ``anchors`` is a part of it. A score is the
    whole-number inner product, held to the range of a long; higher scores come first, ties by smaller id, null
    ids last. Rows of another dimension than the anchor's are not compared. Each of several rows
    with one id is a row of its own, as anchor, positive and negative. An anchor without positives, or a
    positive without negatives in its window (any of negative score has an empty one), gives no row; empty tables give none.
    """
    spark = rows.sparkSession
    names = "anchor long, anchor_id long, id long, score long"
    found = _pairs(rows, anchors).mapInArrow(_first_positives(positives), names)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    best = checkpointed(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives).drop("place"))
    # An anchor has at most `positives` scores.
    bounds = best.groupBy("anchor").agg(F.collect_list("score").alias("found"))
    known = anchors.join(bounds, anchors["row"] == bounds["anchor"]).drop("anchor")
    near = _pairs(rows, checkpointed(known), ["found"]).mapInArrow(_first_negatives(negatives, low, high), names)
    sent = best.withColumn("negative", F.lit(False)).union(near.withColumn("negative", F.lit(True)))
    keyed = sent.rdd.map(lambda r: ((r[0], -r[3], r[4], r[2] is None, r[2] or 0), r[1]))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = keyed.repartitionAndSortWithinPartitions(parts, lambda key: portable_hash(key[0]))
    return spark.createDataFrame(dealt.mapPartitions(lambda it: _emit(it, negatives, low, high)), RESULT, verifySchema=False)
