"""Embedding near-deduplication by collision-counting projections.

Vectors of one label are sorted along many random one-dimensional projections.
A window around each vector (the query) collides with those whose projection is within
``WIDTH`` times the distance of a pair at the threshold. Pairs with at least ``need`` collisions
are verified by cosine in double precision; ``need`` is calibrated so
that a pair at the threshold passes with probability ``RECALL``.

So that windows need not run over a whole label, vectors are first dealt into
cells: in each tree of a label, ``depth`` projections are cut at zero and vectors within
``SPILL`` of a cut go to both sides. The middle of a pair of unit vectors at the threshold
has a known length, at a right angle to their difference, so a cut leaves such a pair
together with one probability (``level_recall``) wherever it lies and however
its label is spread; cuts at a label's mean would not. A label's depth follows its own size and
spread, and its trees follow the depth, until a pair at the threshold shares a cell with
probability ``TREE_RECALL``. A label for which that takes more work than all of its pairs has
one cell. A pair that shares several cells is counted in the
first only, which both ends' projections tell, so each pair is verified once and
nothing need be made distinct. A cell of more than ``BLOCK`` vectors is cut into
blocks, and each pair of blocks is a task of its own: none is capped.

Equal vectors of one label are one class with a multiplicity; copies are never paired.
Tasks emit link counts and one edge per vector, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, column, components

COSINE = 0.93
LINES = 24
WIDTH = 2.0
RECALL = 0.998
TREES = 5
TREE_RECALL = 0.99
SPILL = 0.12
DEEPEST = 60
CELL = 512
BLOCK = 2048
SEED = 7
SALTS = 16
PAIRS_PER_TASK = 1 << 24  # pairs to count in a task, on average
MOST_TASKS = 100_000
_STRIP, _DEAL = 256, 1024


def needed_collisions(lines: int = LINES, width: float = WIDTH, recall: float = RECALL) -> int:
    """The largest count that a pair at the threshold reaches with probability
    ``recall``: its projections differ by a normal variable of the pair's
    distance, so it collides with probability ``erf(width / sqrt 2)``."""
    p = math.erf(width / math.sqrt(2))
    tail = 0.0
    for need in range(lines, -1, -1):
        tail += math.comb(lines, need) * p**need * (1 - p) ** (lines - need)
        if tail >= recall:
            return need
    return 0


def level_recall(cosine: float) -> float:
    """The probability that a cut leaves a pair at the threshold a side in common.
    Its ends lie ``x`` before and after its middle, which is normal with the
    middle's length as deviation; it is parted where the middle is nearer to the cut than
    ``|x| - SPILL``. Pairs above the threshold have a higher one."""
    middle, half = math.sqrt(max(1e-9, (1 + cosine) / 2)), math.sqrt(max(0.0, (1 - cosine) / 2))
    z = (np.arange(4000) + 0.5) / 500
    weight = np.exp(-z * z / 2) / np.exp(-z * z / 2).sum()
    parted = [math.erf(max(0.0, x - SPILL) / middle / math.sqrt(2)) for x in (z * half).tolist()]
    return 1 - float(weight @ np.array(parted))


def needed_trees(depth: int, level: float, least: int = TREES) -> int:
    """Trees of ``depth`` levels, until a pair shares a cell with probability ``TREE_RECALL``."""
    lost = 1 - level**depth
    return max(least, math.ceil(math.log(1 - TREE_RECALL) / math.log(lost))) if lost > 0 else least


def shape(n: int, together: float, level: float, trees: int = TREES, cell: int = CELL) -> tuple[int, int]:
    """Trees and depth for a label of ``n`` vectors whose mean cosine is ``together``: those
    with the fewest pairs to count, a vector's way to a cell costing as many as ``cell``.
    (1, 0), all pairs, where no trees have fewer. The mean cosine decides on the work only."""
    spill = math.erf(SPILL / math.sqrt(2))
    side = min(1.0, 1 - math.acos(max(-1.0, min(1.0, together))) / math.pi + spill / 2)  # two vectors share one
    best, least = (1, 0), float(n)
    for depth in range(1, DEEPEST + 1) if n > cell else ():
        count = needed_trees(depth, level, trees)
        work = count * (n * side**depth + (1 + spill) ** depth * cell)
        if work < least:
            best, least = (count, depth), work
    return best


@dataclass
class Plan:
    """Projections of a label's trees and of the counted lines."""

    trees: int
    depth: int
    split: np.ndarray  # [dimension, tree * depth]
    lines: np.ndarray  # [dimension, line]
    cosine: float
    need: int

    @property
    def reach(self) -> float:
        return WIDTH * math.sqrt(2 - 2 * self.cosine)

    def sides(self, x: np.ndarray) -> np.ndarray:
        """1, 2 or 3 (both) for every vector and cut: [vector, tree, level]."""
        at = x @ self.split
        sides = (at < SPILL).astype(np.uint8) | (at >= -SPILL).astype(np.uint8) << 1
        return sides.reshape(len(x), self.trees, self.depth)


@lru_cache(maxsize=64)
def plan(size: int, trees: int, depth: int, cosine: float) -> Plan:
    """The plan of labels with these trees, for vectors of ``size`` components: the same in every task."""
    rng = np.random.default_rng([SEED, size])
    lines = rng.standard_normal((size, LINES))
    return Plan(trees, depth, rng.standard_normal((size, trees * depth)), lines, cosine, needed_collisions())


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _matrix(values: pa.Array, n: int) -> np.ndarray:
    return values.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _deal(size: int, cosine: float):
    """Task: rows (label, id, n, trees, depth, vector) to a row for every cell a vector is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, id_, n, trees, depth = (batch.column(k).to_numpy() for k in range(5))
            for kind in np.unique(np.stack([trees, depth], 1), axis=0):
                all_, own = np.flatnonzero((trees == kind[0]) & (depth == kind[1])), plan(size, *kind.tolist(), cosine)
                for mine in np.split(all_, range(_DEAL, len(all_), _DEAL)):
                    vectors = batch.column(5).take(pa.array(mine))
                    sides = own.sides(unit(_matrix(vectors, len(mine))))
                    for tree in range(own.trees):
                        row, cell = np.arange(len(mine)), np.zeros(len(mine), np.int64)
                        for level in range(own.depth):
                            side = sides[row, tree, level]
                            left, right = np.flatnonzero(side & 1), np.flatnonzero(side & 2)
                            cell = np.concatenate([cell[left] * 2, cell[right] * 2 + 1])
                            row = np.concatenate([row[left], row[right]])
                        full = lambda x: np.full(len(row), x, np.int64)  # noqa: B023, E731
                        columns = [label[mine][row], full(tree), cell, id_[mine][row], n[mine][row], full(own.trees), full(own.depth)]
                        yield pa.RecordBatch.from_arrays(
                            [*map(pa.array, columns), vectors.take(pa.array(row))], ["label", "tree", "cell", "id", "n", "trees", "depth", "vector"]
                        )

    return run


def _collisions(p: np.ndarray, q: np.ndarray, reach: float) -> np.ndarray:
    """Window collisions of every vector of ``p`` with every one of ``q``, over all
    lines: ``q`` is sorted along each line, and the window of a query is the run
    of its order between two binary searches."""
    count = np.zeros((len(p), len(q) + 1), np.int16)
    rows = np.arange(len(p))
    total = np.zeros((len(p), len(q)), np.int16)
    for line in range(p.shape[1]):
        order = np.argsort(q[:, line], kind="stable")
        sorted_ = q[order, line]
        count[:] = 0
        np.add.at(count, (rows, np.searchsorted(sorted_, p[:, line] - reach, "left")), 1)
        np.add.at(count, (rows, np.searchsorted(sorted_, p[:, line] + reach, "right")), -1)
        total[:, order] += np.cumsum(count[:, :-1], axis=1, dtype=np.int16)
    return total


def _shared_first(plan: Plan, a: np.ndarray, b: np.ndarray, tree: int, cell: int) -> np.ndarray:
    """For pairs of side rows [pair, tree, level]: whether (tree, cell) is the first cell both are in."""
    free = np.ones(len(a), bool)
    for before in range(tree):
        free &= ((a[:, before] & b[:, before]) == 0).any(1)  # a level parts them
    both = a[:, tree] & b[:, tree]
    bits = np.where(both & 1, 0, 1)  # the left side where they share both
    weights = 1 << np.arange(plan.depth - 1, -1, -1)
    return free & (both != 0).all(1) & ((bits * weights).sum(1) == cell)


def cell_links(plan: Plan, tree: int, cell: int, left: tuple, right: tuple | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (index in left, index in right) of verified links; ``right`` None: within left.
    Sides are tuples of unit vectors and their side rows."""
    x, x_sides = left
    y, y_sides = right or left
    p, q = x @ plan.lines, y @ plan.lines
    for at in range(0, len(x), _STRIP):
        strip = slice(at, at + _STRIP)
        i, j = np.nonzero(_collisions(p[strip], q, plan.reach) >= plan.need)
        i += at
        if right is None:
            i, j = i[i < j], j[i < j]
        good = np.einsum("ij,ij->i", x[i], y[j]) >= plan.cosine
        i, j = i[good], j[good]
        good = _shared_first(plan, x_sides[i], y_sides[j], tree, cell)
        yield i[good], j[good]


def _merged(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Roots after the links (i, j): smallest labels spread over the old roots."""
    a, b, label = root[i], root[j], np.arange(len(root))
    while (label[a] != label[b]).any():
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
    return label[root]


def _count(size: int, cosine: float):
    """Task, per pair of blocks of a cell: rows (id, n_links, root) of the vectors with links in it."""

    def run(table: pa.Table) -> pa.Table:
        trees, depth, tree, cell, one, two = (table[c][0].as_py() for c in ("trees", "depth", "tree", "cell", "one", "two"))
        own = plan(size, trees, depth, cosine)
        ids, n = table["id"].to_numpy(), table["n"].to_numpy()
        x = unit(_matrix(table["vector"].combine_chunks(), len(ids)))
        sides = own.sides(x)
        block = table["block"].to_numpy()
        left = np.flatnonzero(block == one)
        right = left if one == two else np.flatnonzero(block == two)
        links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        pair = lambda rows: (x[rows], sides[rows])
        for i, j in cell_links(own, tree, cell, pair(left), None if one == two else pair(right)):
            i, j = left[i], right[j]
            np.add.at(links, i, n[j])
            np.add.at(links, j, n[i])
            root = _merged(root, i, j)
        met = links > 0
        return pa.table({"id": ids[met], "n_links": links[met], "root": ids[root][met]})

    return run


def near_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, trees: int = TREES, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """``id, n_links, component_id, kept``, one row per input row.

    Rows link when their labels are equal and not null and their cosine, in
    double precision, is at least ``cosine``. No pair below it links; of the pairs at or above it
    all are found in labels of up to ``cell`` classes but for those the collision count misses
    (0.2% at the threshold, fewer above), in larger ones at least 99% of these. Null and zero vectors, and vectors
    with null or non-finite components, link with nothing; vectors of different
    lengths do not link. ``n_links`` counts the other rows linked directly, ``component_id``
    is the smallest id reachable, itself included (null ids last); ``kept`` tells
    whether it is the row's own. Repeated rows are rows of their own and link with each other. Labels are of any type
    (text labels are compared by a 64-bit hash). Other columns are not read; an empty table gives no rows.
    """
    spark = table.sparkSession
    label = column(table, label_col)
    whole = isinstance(table.select(label.alias("label")).schema["label"].dataType, T.IntegralType)
    rows = table.select(
        column(table, id_col).alias("id"),
        (label.cast("long") if whole else F.when(label.isNotNull(), F.xxhash64(label))).alias("label"),
        column(table, vector_col).cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    usable = F.col("label").isNotNull() & finite & F.exists("vector", lambda v: v != 0)
    rows = rows.withColumn("vector", F.when(usable, F.transform("vector", lambda v: v + F.lit(0.0))))  # -0.0 is 0.0
    # A class is a label and a vector; its key has two hashes, so hot copies meet in map-side counts.
    key = F.struct("label", F.size("vector").alias("size"), F.xxhash64("label", "vector").alias("h1"), F.hash("vector", "label").alias("h2"))
    rows = checkpointed(rows.withColumn("key", F.when(F.col("vector").isNotNull(), key)))
    classes = rows.where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.first("vector").alias("vector"))
    classes = checkpointed(classes.select("key", "n", "low", "vector", F.monotonically_increasing_id().alias("id")))
    found = [_of_size(classes, r["size"], r["most"], cosine, trees, cell, block) for r in classes.groupBy("key.size", "key.label").count().groupBy("size").agg(F.max("count").alias("most")).collect()]
    links = spark.createDataFrame([], "id long, n_links long, root long")
    for f in found:
        links = links.union(f)
    links = checkpointed(links)
    counts = links.groupBy("id").agg(F.sum("n_links").alias("n_links"))
    found = components(links.select(F.col("id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("v", "id")
    rooted = classes.join(found, "id", "left").withColumn("root", F.coalesce("root", "id"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    by_key = rooted.join(lows, "root").join(counts, "id", "left")
    by_key = by_key.select("key", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    done = rows.drop("vector").join(by_key, "key", "left")
    component = F.coalesce("component_id", "id")
    return done.select("id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def _of_size(classes: DataFrame, size: int, most: int, cosine: float, trees: int, cell: int, block: int) -> DataFrame:
    """Links among the classes whose vectors have ``size`` components."""
    mine = classes.where(F.col("key.size") == size).select(F.col("key.label").alias("label"), "id", "n", "vector")
    one = {"trees": F.lit(1).cast("long"), "depth": F.lit(0).cast("long")}
    mine = _shaped(mine, cosine, trees, cell) if most > cell else mine.withColumns(one)
    mine = mine.select("label", "id", "n", "trees", "depth", "vector")
    dealt = mine.mapInArrow(_deal(size, cosine), "label long, tree long, cell long, id long, n long, trees long, depth long, vector array<double>")
    place = ["label", "tree", "cell"]
    sizes = checkpointed(dealt.groupBy(*place).agg(F.count("*").alias("size")).where("size > 1"))
    # Groups are dealt by the pairs they stand for: adaptive execution would merge them by bytes.
    pairs = sizes.agg(F.sum(F.col("size").cast("double") * F.col("size") / 2)).first()[0] or 0.0
    least = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = int(min(max(least, pairs // PAIRS_PER_TASK + 1), MOST_TASKS))
    blocks = F.ceil(F.col("size") / block).cast("long")
    dealt = dealt.join(sizes.select(*place, blocks.alias("blocks")), place)
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"one": F.least("block", "other"), "two": F.greatest("block", "other")}).drop("other", "blocks")
    dealt = dealt.repartition(parts, *place, "one", "two")
    return dealt.groupBy(*place, "one", "two").applyInArrow(_count(size, cosine), "id long, n_links long, root long")


def _shaped(mine: DataFrame, cosine: float, trees: int, cell: int) -> DataFrame:
    """``mine`` with the ``trees`` and ``depth`` of its label. Nothing comes to the
    driver; the few rows of a label are copied ``SALTS`` times and its vectors
    dealt over the copies, so a hot label's join is split."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v)).alias("norm")
    rows = mine.select("label", norm, F.posexplode("vector").alias("at", "v"))
    means = rows.groupBy("label", "at").agg(F.avg(F.col("v") / F.col("norm")).alias("mean"), F.count("*").alias("n"))
    labels = means.groupBy("label").agg(F.max("n").alias("n"), F.sum(F.col("mean") * F.col("mean")).alias("together"))
    level = level_recall(cosine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shape(n, mean, level, trees, cell) for n, mean in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            columns = [batch.column(0), *(pa.array([f[k] for f in found], pa.int64()) for k in range(2))]
            yield pa.RecordBatch.from_arrays(columns, ["label", "trees", "depth"])

    shapes = labels.where(F.col("n") > cell).mapInArrow(run, "label long, trees long, depth long").where("depth > 0")
    shapes = shapes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = mine.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    done = salted.join(shapes, ["label", "salt"], "left").drop("salt")
    return done.withColumns({"trees": F.coalesce("trees", F.lit(1).cast("long")), "depth": F.coalesce("depth", F.lit(0).cast("long"))})
