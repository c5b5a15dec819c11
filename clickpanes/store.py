"""Partitioned Parquet stores with a commit log.

Every write to a store is a *run* with a key of the caller's (a backfill's name, a
stream's batch number). A run's files lie in the store's ordinary partition folders, and
their names begin with the tag of one attempt. They count only when a commit
names that tag as the run's own, so

* a run that ends before its commit leaves nothing that a reader of the store sees;
* a run that is done again replaces what it wrote, it never adds to it;
* many files become visible, or are replaced, at one instant.

The log is a folder of numbered files, each the whole table of runs. A commit writes
the next number and moves it into place, which fails if another writer was
first; it then starts from that writer's table. Readers take the last number. The table
stays short where runs are folded by ``compact``.
"""

from __future__ import annotations

import copy
import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = "_commits"
#: ``runs``: key -> tag, and the partition value up to which its rows have been folded; ``marks``: last number of each sequence.
EMPTY = '{"runs": {}, "marks": {}, "folded": []}'
#: Earlier states that are kept, for readers that have just listed the log.
KEPT_STATES = 8
ATTEMPTS = 50
#: A file's name: the tag, the task's number and the write job's id.
_FILE = re.compile(r"(run-.+)-\d{5,}-[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}\b")
#: A task's share of a partition value: values with more raw bytes are split.
FILE_BYTES = 256 << 20
#: Rows of a Parquet page: pages are skipped by their least and greatest values.
PAGE_ROWS = 512


class Log:
    """The commit log of one folder, on whatever file system it is."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self.folder = f"{path.rstrip('/')}/{LOG}"
        self._fs = self._path(self.folder).getFileSystem(self._conf)

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def _names(self) -> list[str]:
        if not self._fs.exists(self._path(self.folder)):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder))]

    def numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names() if re.fullmatch(r"\d{12}\.json", n))

    def _read(self, number: int) -> dict:
        stream = self._fs.open(self._path(f"{self.folder}/{number:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def state(self) -> dict:
        """The table of the last commit, an empty one for a store without any."""
        for _ in range(ATTEMPTS):
            numbers = self.numbers()
            if not numbers:
                return json.loads(EMPTY)
            try:
                return self._read(numbers[-1])
            except Exception:  # removed since it was listed: a later one is there
                if numbers[-1] in self.numbers():
                    raise
        raise RuntimeError(f"{self.folder} changes too fast to be read")

    def commit(self, change: Callable[[dict], dict]) -> dict:
        """Put ``change(last table)`` as the next table and return it; a table that does not change is not written."""
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.folder).toUri(), self._conf)
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        plain = self._gateway.new_array(rename, 0)
        self._fs.mkdirs(self._path(self.folder))
        for _ in range(ATTEMPTS):
            numbers = self.numbers()
            before = self._read(numbers[-1]) if numbers else json.loads(EMPTY)
            after = change(copy.deepcopy(before))
            if after == before:
                return after
            staged = self._path(f"{self.folder}/.{uuid.uuid4().hex}")
            out = self._fs.create(staged, False)
            out.write(bytearray(json.dumps(after, sort_keys=True).encode()))
            out.close()
            target = self._path(f"{self.folder}/{(numbers[-1] + 1) if numbers else 0:012d}.json")
            try:
                context.rename(staged, target, plain)
            except Exception:
                self._fs.delete(staged, False)
                if not self._fs.exists(target):
                    raise
                continue  # another writer was first
            for old in numbers[: -KEPT_STATES]:
                self._fs.delete(self._path(f"{self.folder}/{old:012d}.json"), False)
            return after
        raise RuntimeError(f"{self.folder}: no commit in {ATTEMPTS} attempts")


    def delete(self, pattern: str) -> int:
        """Delete the files of the store that match a glob below its folder; their number."""
        found = self._fs.globStatus(self._path(f"{self.folder[: -len(LOG) - 1]}/{pattern}")) or []
        for status in found:
            self._fs.delete(status.getPath(), True)
        return len(found)

    def _files(self, pattern: str) -> list[str]:
        found = self._fs.globStatus(self._path(f"{self.folder[: -len(LOG) - 1]}/{pattern}")) or []
        return [f.getPath().toString() for f in found]

    def files_of(self, tag: str, partition_by: str) -> list[tuple[int | None, str]]:
        """The files of an attempt, each with its value (a whole number, or None) of the partition column."""
        out = []
        for path in self._files(f"{partition_by}=*/{tag}-*"):
            value = path.rsplit("/", 2)[1].split("=", 1)[1]
            out.append((None if value.startswith("__HIVE") else int(value), path))
        return out

    def remove(self, files: list[str]) -> None:
        for path in files:
            self._fs.delete(self._path(path), False)

    def tags(self) -> set[str]:
        """The tags of all attempts that have files."""
        names = (path.rsplit("/", 1)[1] for path in self._files("*/run-*"))
        return {m[1] for name in names if (m := _FILE.match(name))}


def _tag(key: str) -> str:
    """A new attempt's tag: characters of a file name that are none of a glob."""
    return f"run-{re.sub(r'[^A-Za-z0-9]', '-', key)}-{uuid.uuid4().hex[:12]}"


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes before encoding."""
    size: Column = F.lit(0)
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
        else:
            size = size + F.lit(8)
    return size.cast("long")


def split_by_size(df: DataFrame, key: str, order: list[str], file_bytes: int = FILE_BYTES) -> DataFrame:
    """Deal rows to tasks for a write partitioned by ``key``: one task for each value, and for
    a value of more than ``file_bytes`` as many, side by side, as it has such shares.

    The sizes are measured: one aggregation, combined map-side, and of its result only values above
    the bound are kept. These are at most total bytes / ``file_bytes`` rows, so their side of
    the join is small by construction. Rows are sorted by ``key`` and ``order`` within a task, so
    pages and row groups hold narrow ranges.
    """
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    sizes = df.groupBy(F.col(key).alias("_value")).agg(F.sum(row_bytes(df)).alias("_bytes"))
    large = sizes.where(F.col("_bytes") > file_bytes)
    large = large.select("_value", F.ceil(F.col("_bytes") / file_bytes).cast("int").alias("_shares"))
    known = df.join(F.broadcast(large), F.col(key).eqNullSafe(F.col("_value")), "left")
    rest = [F.xxhash64(*[c for c in df.columns if c != key])] if len(df.columns) > 1 else [F.lit(0)]
    share = F.when(F.col("_shares").isNull(), F.lit(0)).otherwise(F.pmod(rest[0], F.col("_shares")))
    task = F.pmod(F.xxhash64(F.col(key)) + share, F.lit(n)).cast("int")
    return known.select(*df.columns, task.alias("_task")).repartitionById(n, F.col("_task")).drop("_task").sortWithinPartitions(key, *order)


def by_value(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """As ``split_by_size`` for a batch job, where adaptive execution measures the shuffle itself: small
    values are merged into tasks, a value with a large share is split."""
    return df.hint("rebalance", key).sortWithinPartitions(key, *order)


#: Timestamps as 64-bit numbers: of these (not of the default's 96 bits) files hold the least and greatest values.
_TIMES, _MICROS = "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS"


#: Local folders without checksum files beside the data, whose permissions Hadoop sets by two processes a file; the
#: sums of Parquet's pages lie in the files and are compared instead. Other file systems are not concerned.
_PLAIN = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
_PAGE_SUMS = {"parquet.page.verify-checksum.enabled": "true"}
#: Tasks that list the folders of a store: so many for each core, not one for each folder.
_LISTING, LISTERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 4


def _plain_files(spark: SparkSession) -> dict[str, str]:
    """``_PLAIN`` as options of a writer, unless the session has a local file system of its own choice."""
    return {} if spark._jsc.hadoopConfiguration().get("fs.file.impl") else _PLAIN


def _load(spark: SparkSession, path: str, schema: T.StructType, glob: str) -> DataFrame:
    """The files of a store that match ``glob``. Its folders are listed at once, so the setting is changed for that time."""
    conf = spark.conf
    before = conf.get(_LISTING)
    conf.set(_LISTING, min(int(before), LISTERS * max(spark.sparkContext.defaultParallelism, 1)))
    try:
        return spark.read.schema(schema).options(**_PAGE_SUMS).option("pathGlobFilter", glob).parquet(path)
    finally:
        conf.set(_LISTING, before)


def write_parquet(rows: DataFrame, path: str, partition_by: str, mode: str = "append", page_rows: int = PAGE_ROWS, basename: str | None = None) -> None:
    """Write Parquet folders whose pages can be skipped by any column, timestamps included.

    How timestamps are written has no writer option, so the session's setting is changed
    for the time of the write and then put back."""
    conf = rows.sparkSession.conf
    writer = rows.write.mode(mode).partitionBy(partition_by).options(**_plain_files(rows.sparkSession))
    writer = writer.option("compression", "snappy").option("parquet.page.row.count.limit", page_rows)
    writer = writer.option("mapreduce.output.basename", basename) if basename else writer
    before = conf.get(_TIMES)
    conf.set(_TIMES, _MICROS)
    try:
        writer.parquet(path)
    finally:
        conf.set(_TIMES, before)


def publish(rows: DataFrame, path: str, run: str, partition_by: str, page_rows: int = PAGE_ROWS, mark: tuple[str, int] | None = None) -> bool:
    """Write rows (dealt to tasks by ``by_value`` or ``split_by_size``) as the run ``run`` of the store and commit it.

    What the run wrote before leaves the store by the same commit, and its files are deleted after it. A
    run that ``compact`` has folded cannot be replaced any more, which is an error. ``mark``
    names a sequence and the run's number in it: a number up to the last one committed is
    there already and is not written again (False)."""
    spark = rows.sparkSession
    log, tag = Log(spark, path), _tag(run)
    before = log.state()
    if mark and mark[1] <= before["marks"].get(mark[0], -1):
        return False
    if run in before["folded"]:
        raise ValueError(f"run {run!r} has been compacted and cannot be replaced")
    write_parquet(rows, path, partition_by, page_rows=page_rows, basename=tag)
    gone: list[str] = []

    def change(table: dict) -> dict:
        if run in table["folded"]:
            raise ValueError(f"run {run!r} has been compacted and cannot be replaced")
        gone[:] = [table["runs"][run]["tag"]] if run in table["runs"] else []
        table["runs"][run] = {"tag": tag, "after": None}
        if mark:
            table["marks"][mark[0]] = mark[1]
        return table

    log.commit(change)
    for old in gone:
        log.delete(f"*/{old}-*")
    return True


def read_store(spark: SparkSession, path: str, schema: T.StructType, partition_by: str = "hour", runs: list[str] | None = None) -> DataFrame:
    """What the committed runs (all, or those given) of a store hold; predicates on the
    partition column prune folders. A folder without a log is read as it is."""
    log = Log(spark, path)
    if not log.numbers():
        return spark.read.schema(schema).parquet(path)
    by_bound: dict = {}
    for key, run in log.state()["runs"].items():
        if runs is None or key in runs:
            by_bound.setdefault(run["after"], []).append(run["tag"])
    out = None
    for after, tags in by_bound.items():
        glob = "{" + ",".join(f"{t}-*" for t in sorted(tags)) + "}"
        part = _load(spark, path, schema, glob)
        part = part if after is None else part.where((F.col(partition_by) > after) | F.col(partition_by).isNull())
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition_by: str,
    order: list[str],
    until: int | None = None,
    prefix: str = "batch-",
    page_rows: int = PAGE_ROWS,
) -> int:
    """Fold the runs whose key begins with ``prefix`` (a stream's batches) into one; their number.

    With ``until``, only values of the partition column up to it are folded (the closed hours of a store that still
    grows): rows of these runs beyond it, or without a value, stay theirs, and nothing beyond it is read. The rows are
    those of one commit, and one commit puts the new files in the place of the old, so a reader
    sees either; runs committed meanwhile stay. A compaction that fails before its commit changes nothing, and
    one with nothing to fold does nothing. A folded run can no longer be replaced."""
    log = Log(spark, path)
    table = log.state()["runs"]
    old = [k for k in table if k.startswith(prefix) and (until is None or table[k]["after"] is None or table[k]["after"] < until)]
    if not old:
        return 0
    rows = read_store(spark, path, schema, partition_by, old)
    rows = rows if until is None else rows.where(F.col(partition_by) <= until)
    run = f"compacted-{uuid.uuid4().hex[:12]}"
    tag = _tag(run)
    write_parquet(by_value(rows, partition_by, order), path, partition_by, page_rows=page_rows, basename=tag)
    files = {k: log.files_of(table[k]["tag"], partition_by) for k in old}
    beyond = {k for k in old if until is not None and any(v is None or v > until for v, _ in files[k])}

    def change(now: dict) -> dict:
        if any(now["runs"].get(k) != table[k] for k in old):
            raise RuntimeError("a run was replaced while it was folded; fold again")
        for k in old:
            if k in beyond:
                now["runs"][k]["after"] = until
            else:
                del now["runs"][k]
            # A stream's batches are known by its mark; only other runs have to be remembered.
            if not k.startswith("batch-") and k not in now["folded"]:
                now["folded"].append(k)
        now["runs"][run] = {"tag": tag, "after": None}
        return now

    log.commit(change)
    log.remove([path for k in old for v, path in files[k] if until is None or (v is not None and v <= until)])
    return len(old)


def sweep(spark: SparkSession, path: str) -> int:
    """Delete the files of attempts that no commit names; only while no run writes. Their number."""
    log = Log(spark, path)
    live = {run["tag"] for run in log.state()["runs"].values()}
    return sum(log.delete(f"*/{tag}-*") for tag in log.tags() - live)
