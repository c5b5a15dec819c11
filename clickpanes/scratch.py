"""Shared scratch space for intermediate tables, stream checkpoints and
round-trip outputs.

The root is the cluster's ``spark.checkpoint.dir`` (a shared file system). Only
on a one-machine ``local`` master that has none set, as in tests, it is a
fresh temporary folder; a cluster without one gets an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_FOLDER = "clickpanes"
_made: dict[str, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if sc.master != "local" and not sc.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="clickpanes-")
        sc.setCheckpointDir(shared)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch root, until ``clear_scratch``."""
    path = f"{scratch_root(spark)}/{_FOLDER}/{name}-{uuid.uuid4().hex[:12]}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clear_scratch(spark: SparkSession) -> int:
    """Delete every path this session took from ``scratch_path`` (after the
    results that read them are used); their number. See ``clear_checkpoints``
    for reliable checkpoints."""
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete_path(spark, path)
    return len(paths)


def clear_checkpoints(spark: SparkSession) -> int:
    """Delete the reliable checkpoints, and the written tables beside them, of this session (after the results that
    read them are used); the number of folders. Spark gives every session a checkpoint folder of its own, so nothing of
    another one is touched; scratch paths stay. Where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is
    set, Spark deletes checkpoints itself once nothing refers to them."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        return 0
    root = spark._jvm.org.apache.hadoop.fs.Path(sc.getCheckpointDir())
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName() != _FOLDER] if fs.exists(root) else []
    for path in found:
        fs.delete(path, True)
    return len(found)
