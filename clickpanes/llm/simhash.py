"""SimHash near-deduplication by deletion-variant signatures.

Of two 64-bit fingerprints that differ in at most three bits, one of the two
32-bit halves differs in at most one. Every distinct fingerprint is indexed under
64 keys: each half with each of its bits made a wildcard. An equality shuffle
on the key brings every such pair together, and the full distance verifies it.

Equal fingerprints are one vertex, so copies are never paired. In a key with
few fingerprints each pair is tested (and emitted under the first key it shares
only); in a larger one a search from unvisited fingerprints emits one link per
fingerprint. Keys above ``LARGE`` fingerprints are not held: their rows go on to
a second index, which splits the other half in the same way. There a group
has at most 18 free bits, so its size is bounded. No link is lost anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, column, components, keep_rows

BITS, HALF = 64, 32
SHINGLE = 3
DISTANCE = 3
SEED = 42
SMALL, LARGE = 32, 4096
_BLOCK = 1 << 16
LINKS = "deferred boolean, a long, b long, k1 long"


def fingerprint(text: str | None) -> int:
    """64-bit SimHash of lower-cased word shingles, as a signed integer."""
    joined = b" ".join((text or "").encode("utf-8", "replace").lower().split())
    if not joined:
        return 0
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(joined)]
    # A shingle is a slice of the joined words; fewer words than a shingle: all of them.
    starts, ends = starts[: max(1, len(starts) - SHINGLE + 1)], ends[min(len(ends), SHINGLE) - 1 :]
    digest, ones = xxhash.xxh64_digest, np.zeros(BITS, np.int64)
    for k in range(0, len(starts), _BLOCK):
        hashes = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[k : k + _BLOCK], ends[k : k + _BLOCK])])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big", signed=True)


@F.arrow_udf(T.LongType())
def fingerprint_udf(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        yield pa.array([fingerprint(t.as_py()) for t in batch], pa.int64())


def _first_shared(x: np.ndarray) -> np.ndarray:
    """The first key (0 to 63) that two fingerprints with XOR ``x`` share."""
    low, high = x & np.uint64(0xFFFFFFFF), x >> np.uint64(HALF)
    at = lambda part: np.bitwise_count(part - np.uint64(1)).astype(np.int64)  # noqa: E731  index of a single bit
    by_low = np.bitwise_count(low) <= 1
    return np.where(by_low, np.where(low == 0, 0, at(low)), HALF + np.where(high == 0, 0, at(high)))


def _search(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A link from every fingerprint to the start of its search."""
    left, out_a, out_b = fps, [], []
    while len(left):
        root, wave, left = left[0], [left[0]], left[1:]
        while wave and len(left):
            near = np.bitwise_count(left ^ wave.pop()) <= DISTANCE
            if near.any():
                out_a.append(left[near])
                out_b.append(np.full(len(out_a[-1]), root))
                wave.extend(out_a[-1])
                left = left[~near]
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def _spread(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for a group with few free bits: smallest-label spreading over
    the cube of the free bits, by all masks of up to three bits."""
    free = [k for k in range(BITS) if int(np.bitwise_or.reduce(fps ^ fps[0])) >> k & 1]
    at = np.zeros(len(fps), np.int64)
    for place, k in enumerate(free):
        at |= ((fps >> np.uint64(k)) & np.uint64(1)).astype(np.int64) << place
    label = np.full(1 << len(free), len(fps), np.int64)
    label[at] = np.arange(len(fps))
    ones = [1 << k for k in range(len(free))]
    masks = {a | b | c for a in [0, *ones] for b in [0, *ones] for c in [0, *ones]} - {0}
    while True:
        best = label[at]
        for mask in masks:
            best = np.minimum(best, label[at ^ mask])
        best = np.minimum(best, label[at[best]])
        if (best == label[at]).all():
            return fps, fps[best]
        label[at] = best


def group_links(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what a group's distinct fingerprints connect."""
    if len(fps) <= LARGE:
        return _search(fps)
    return _spread(fps)


def _rows(a, b, deferred=False, k1=None) -> pa.RecordBatch:
    n = len(a)
    k1 = np.zeros(n, np.int64) if k1 is None else k1
    values = [pa.array(np.full(n, deferred)), a.view(np.int64), b.view(np.int64), k1]
    return pa.RecordBatch.from_arrays([values[0], *map(pa.array, values[1:])], ["deferred", "a", "b", "k1"])


def _linked(batches: Iterator[pa.RecordBatch], defer: bool) -> Iterator[pa.RecordBatch]:
    """Links of rows (k1, k2, fp) sorted by key; only the last, open group is
    carried on. ``defer``: a group above ``LARGE`` is passed on, not carried."""
    held = np.zeros((3, 0), np.int64)
    passing = None
    for batch in batches:
        held = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns])], axis=1)
        if not held.shape[1]:
            continue
        change = np.flatnonzero((held[0, 1:] != held[0, :-1]) | (held[1, 1:] != held[1, :-1])) + 1
        if passing is not None:
            end = int(change[0]) if len(change) else held.shape[1]
            if (held[0, 0], held[1, 0]) == passing:
                yield _rows(held[2, :end], held[2, :end], True, held[0, :end])
                held, change = held[:, end:], change[1:] - end
            if held.shape[1]:
                passing = None
        last = int(change[-1]) if len(change) else 0
        if last:
            yield from _closed(held[:, :last], change[:-1], defer)
            held = held[:, last:]
        if defer and held.shape[1] > LARGE:
            passing = (held[0, 0], held[1, 0])
            yield _rows(held[2], held[2], True, held[0])
            held = held[:, :0]
    if held.shape[1]:
        yield from _closed(held, np.zeros(0, np.int64), defer)


def _closed(rows: np.ndarray, change: np.ndarray, defer: bool) -> Iterator[pa.RecordBatch]:
    """Links of whole groups, which start at 0 and at ``change``."""
    edges = np.concatenate([[0], change, [rows.shape[1]]])
    sizes = np.diff(edges)
    for g in np.flatnonzero(sizes > SMALL):
        own = rows[:, edges[g] : edges[g + 1]]
        if defer and sizes[g] > LARGE:
            yield _rows(own[2], own[2], True, own[0])
        else:
            yield _rows(*group_links(own[2].view(np.uint64)))
    end = np.repeat(np.where(sizes > SMALL, 0, edges[1:]), sizes)  # of a row's group
    here = np.arange(rows.shape[1])
    fps, key = np.ascontiguousarray(rows[2]).view(np.uint64), rows[0] >> HALF
    for lag in range(1, SMALL):
        here = here[here + lag < end[here]]
        if not len(here):
            break
        x = fps[here] ^ fps[here + lag]
        # The second index has no such rule; a link that comes twice does no harm.
        good = (np.bitwise_count(x) <= DISTANCE) & ((rows[1, here] >= 0) | (_first_shared(x) == key[here]))
        if good.any():
            yield _rows(fps[here[good]], fps[here[good] + lag])


def _variant(value: Column, bit: Column) -> Column:
    """``value`` with a bit made 0, below the bit's number."""
    return value.bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), bit)))


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """``a, b``: links among the distinct longs ``fp`` that connect all, and only,
    what distances of up to three bits connect."""
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", HALF)
    keyed = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("bit"))
    half = F.when(F.col("bit") < HALF, low).otherwise(high)
    k1 = F.shiftleft(F.col("bit").cast("long"), HALF).bitwiseOR(_variant(half, F.col("bit") % HALF))
    first = keyed.select(k1.alias("k1"), "fp").repartition("k1").sortWithinPartitions("k1", "fp")
    first = first.select("k1", F.lit(-1).cast("long").alias("k2"), "fp")
    found = checkpointed(first.mapInArrow(lambda batches: _linked(batches, True), LINKS))
    rest = found.where("deferred").select("k1", F.col("a").alias("fp"))
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", HALF)
    other = F.when(F.shiftright("k1", HALF) < HALF, high).otherwise(low)
    rest = rest.select("k1", "fp", other.alias("other"), F.explode(F.sequence(F.lit(0), F.lit(HALF - 1))).alias("bit"))
    quarter = F.when(F.col("bit") < 16, F.col("other").bitwiseAND(F.lit(0xFFFF))).otherwise(F.shiftright("other", 16))
    k2 = F.shiftleft(F.col("bit").cast("long"), 16).bitwiseOR(_variant(quarter, F.col("bit") % 16))
    second = rest.select("k1", k2.alias("k2"), "fp").repartition("k1", "k2").sortWithinPartitions("k1", "k2", "fp")
    second = second.mapInArrow(lambda batches: _linked(batches, False), LINKS)
    return found.where("NOT deferred").select("a", "b").union(second.select("a", "b")).distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text_hash, fp, component_id``, one row per input row.

    ``component_id`` is the smallest id reachable over links (null where no
    row of the component has one). Null and blank texts have fingerprint zero
    and are linked like any other; an empty table gives an empty result; other
    columns are not read.
    """
    rows, rooted = _rooted(docs, id_col, text_col, F.min("id"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = rooted.select("fp", "root").join(lows, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("id", "text_hash", "fp", "component_id")


def _rooted(docs: DataFrame, id_col: str, text_col: str, low: Column) -> tuple[DataFrame, DataFrame]:
    """Rows ``id, text_hash, fp``, and every fingerprint with the ``root`` of its
    component and ``low`` over its rows."""
    rows = docs.select(
        column(docs, id_col).alias("id"),
        F.xxhash64(column(docs, text_col)).alias("text_hash"),
        fingerprint_udf(column(docs, text_col).cast("string")).alias("fp"),
    )
    rows = checkpointed(rows)
    fps = checkpointed(rows.groupBy("fp").agg(low.alias("low")))
    found = components(fingerprint_links(fps.select("fp"))).withColumnRenamed("v", "fp")
    return rows, fps.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of every component, all columns kept: that of the
    smallest id (null ids last), of rows that repeat it the smallest by text hash."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash"))
    _, rooted = _rooted(docs, id_col, text_col, first)
    kept = rooted.groupBy("root").agg(F.min("low").alias("low")).select("low.id", "low.text_hash")
    return keep_rows(docs, kept, id_col, text_col)
