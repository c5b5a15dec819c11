"""Streaming sinks: files (Parquet/CSV, partitioned), console, fan-out."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from clickpanes.store import FILE_BYTES, PAGE_ROWS, Log, publish, split_by_size


def apply_trigger(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """``None`` (as fast as possible), ``'availableNow'``, ``'once'`` or a
    processing-time interval such as ``'1 minute'``."""
    if trigger is None:
        return writer
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


# Files that one key value may get per micro-batch, and tasks that share it.
FILES_PER_KEY = 4


def cluster_for_write(
    df: DataFrame, key: str, spread: Sequence[str], files_per_key: int = FILES_PER_KEY
) -> DataFrame:
    """Group rows by the partition key before a partitioned write.

    One hash shuffle on the key and a salt below ``files_per_key`` (a hash of
    the ``spread`` columns): a key value gets at most that many files per
    batch, and one that holds a large share of the rows is shared by as many
    tasks. Nothing is sampled, so the rows are computed once.
    """
    if files_per_key < 1:
        raise ValueError(f"files_per_key must be at least 1, got {files_per_key}")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, F.col(key), F.pmod(F.xxhash64(*spread), F.lit(files_per_key)))


def start_file_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: str | None = None,
    trigger: str | None = None,
    query_name: str | None = None,
    options: dict[str, str] | None = None,
    spread: Sequence[str] = (),
    files_per_key: int = FILES_PER_KEY,
) -> StreamingQuery:
    """Append a stream to files; exactly once through the sink's log and the
    checkpoint. With ``partition_by`` and ``spread``, rows are first clustered
    by the key (see ``cluster_for_write``), so each batch writes few files
    per folder."""
    if partition_by and spread:
        df = cluster_for_write(df, partition_by, spread, files_per_key)
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if query_name:
        writer = writer.queryName(query_name)
    return apply_trigger(writer, trigger).start(path)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream a checkpoint belongs to (it outlives restarts; a new checkpoint has a new one)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/metadata")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())["id"]
    finally:
        stream.close()


def start_store_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: str,
    order: Sequence[str] = (),
    trigger: str | None = None,
    query_name: str | None = None,
    file_bytes: int = FILE_BYTES,
    page_rows: int = PAGE_ROWS,
) -> StreamingQuery:
    """Append a stream to a Parquet store with a commit log (``clickpanes.store``).

    Each batch is one run of the store: its files, one for each partition value it has rows
    for (more only for a value above ``file_bytes``, which that many tasks share), become visible together,
    and a batch that comes again after a failure replaces what it wrote, or is known to be
    there. The sizes of the values are counted per batch, so the batch is persisted meanwhile. ``compact`` folds the
    batches of closed partition values."""

    def each(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        stream = stream_id(spark, checkpoint)
        batch.persist()
        try:
            rows = split_by_size(batch, partition_by, list(order), file_bytes)
            publish(rows, path, f"batch-{stream}-{epoch}", partition_by, page_rows, mark=(stream, epoch))
        finally:
            batch.unpersist()

    writer = df.writeStream.outputMode("append").foreachBatch(each).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return apply_trigger(writer, trigger).start()


def start_console(df: DataFrame, query_name: str | None = None, trigger: str | None = None) -> StreamingQuery:
    writer = df.writeStream.format("console").outputMode("append")
    if query_name:
        writer = writer.queryName(query_name)
    return apply_trigger(writer, trigger).start()


def start_fan_out(
    df: DataFrame,
    sinks: Sequence[Callable[[DataFrame, int], None]],
    checkpoint: str,
    trigger: str | None = None,
    query_name: str | None = None,
    commit_to: str | None = None,
) -> StreamingQuery:
    """One source read per micro-batch, several outputs: the batch is
    persisted once and handed to every sink function ``f(batch, epoch)``.

    A batch that failed half-way comes again with the same epoch, so a sink
    must replace what it wrote for that epoch; ``epoch_sink`` does.

    With ``commit_to`` (a folder of its own), an epoch is committed there once every sink has written it, and
    readers that are given the folder (``read_epochs``) see an epoch of all sinks or of none. A committed
    epoch that comes again is left as it is, so nothing a reader may be reading is overwritten."""

    def each(batch: DataFrame, epoch: int) -> None:
        log = Log(batch.sparkSession, commit_to) if commit_to else None
        if log and epoch <= log.state()["marks"].get(EPOCH, -1):
            return
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, epoch)
        finally:
            batch.unpersist()
        if log:
            log.commit(lambda table: table | {"marks": table["marks"] | {EPOCH: epoch}})

    writer = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return apply_trigger(writer, trigger).start()


# Fixed value: partition column of the folders ``epoch_sink`` writes.
EPOCH = "epoch"


def epoch_sink(
    path: str, fmt: str = "parquet", build: Callable[[DataFrame], DataFrame] | None = None
) -> Callable[[DataFrame, int], None]:
    """A sink for ``start_fan_out``: every epoch has a folder of its own, which
    a retry overwrites, so each batch is there exactly once. ``build`` derives
    what is written from the batch. Read back with ``read_epochs``."""

    def write(batch: DataFrame, epoch: int) -> None:
        out = build(batch) if build else batch
        out.write.mode("overwrite").format(fmt).save(f"{path}/{EPOCH}={epoch}")

    return write


def read_epochs(spark: SparkSession, path: str, schema, fmt: str = "parquet", commit_to: str | None = None) -> DataFrame:
    """What ``epoch_sink`` wrote under ``path``, all epochs together; with ``commit_to``,
    the epochs that every sink of the stream has written (epochs are numbered from 0 without a gap)."""
    if commit_to is None:
        return spark.read.schema(schema).format(fmt).load(f"{path}/{EPOCH}=*")
    last = Log(spark, commit_to).state()["marks"].get(EPOCH, -1)
    if last < 0:
        return spark.createDataFrame([], schema)
    # The epoch is a partition column here, so folders beyond the last commit are not opened.
    kind = spark.createDataFrame([], schema).schema
    rows = spark.read.schema(T.StructType([*kind.fields, T.StructField(EPOCH, T.LongType())])).format(fmt).load(path)
    return rows.where(F.col(EPOCH) <= last).drop(EPOCH)
