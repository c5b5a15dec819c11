"""Scratch space: shared folder, and nothing left behind."""

import os
from types import SimpleNamespace

import pytest

from clickpanes import scratch
from clickpanes.plans import catalog
from conftest import SF_SMALL


def test_a_cluster_needs_a_shared_folder():
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_root(session)


def test_round_trips_are_deleted(spark):
    root = scratch.scratch_root(spark).replace("file:", "") + "/clickpanes"
    assert catalog.q_states_from_csv(spark, SF_SMALL).count() > 20
    assert catalog.q_product_views_stream(spark, SF_SMALL).count() > 0
    assert os.listdir(root)
    assert scratch.clear_scratch(spark) > 0
    assert os.listdir(root) == []


def test_checkpoints_are_deleted(spark):
    root = scratch.scratch_root(spark).replace("file:", "")
    assert spark.range(10).checkpoint().count() == 10
    kept = scratch.scratch_path(spark, "kept")
    spark.range(3).write.parquet(kept)
    assert any(name.startswith("rdd-") for name in os.listdir(root))
    assert scratch.clear_checkpoints(spark) > 0
    assert os.listdir(root) == ["clickpanes"] and spark.read.parquet(kept).count() == 3
    assert scratch.clear_checkpoints(spark) == 0
