"""Measure how a hot key spreads over shuffle tasks (Spark event log).

Usage: python skew_check.py [sf_dir] [copies]

Clicks with state are derived from the events table (read ``copies``
times), and one third of them is forced onto a single (product, state)
key. Each plan below runs with the event log written to a fresh scratch
folder; per shuffle-reading stage the script reports the largest share of
records any one task read. Prints one JSON object.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

import zstandard
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from clickpanes.functions.sampling import stable_bucket
from clickpanes.operators.dims import with_state
from clickpanes.operators.parse import click_times
from clickpanes.operators.views import product_views, views_by_window
from clickpanes.plans import catalog
from clickpanes.sources.tables import event_lines


def stage_shares(log_dir: str) -> dict[int, dict]:
    path = glob.glob(f"{log_dir}/*/events_*")[0]
    raw = open(path, "rb")
    text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8") if path.endswith(".zstd") else io.TextIOWrapper(raw, encoding="utf-8")
    per_stage: dict[int, list[int]] = {}
    jobs: dict[int, str] = {}
    for line in text:
        e = json.loads(line)
        if e["Event"] == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            rd = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            if rd:
                per_stage.setdefault(e["Stage ID"], []).append(rd)
        elif e["Event"] == "SparkListenerJobStart":
            desc = (e.get("Properties") or {}).get("spark.job.description", "")
            for s in e["Stage IDs"]:
                jobs[s] = desc
    out = {}
    for sid, recs in per_stage.items():
        out[sid] = {"label": jobs.get(sid, ""), "tasks": len(recs), "records": sum(recs),
                    "max_task_share": round(max(recs) / sum(recs), 3)}
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    log_dir = tempfile.mkdtemp(prefix="skew-events-", dir="/tmp")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "false")  # fixed 8 tasks per stage, comparable
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    events = spark.read.parquet(*[f"{sf_dir}/events.parquet"] * copies).repartition(8)
    clicks = with_state(click_times(event_lines(events)), catalog.zip_states(spark, sf_dir))
    hot = stable_bucket(F.concat_ws("|", "product_id", "state", F.col("date_time").cast("string")), 3) == 0
    skewed = clicks.select(
        F.when(hot, F.lit(0).cast("bigint")).otherwise(F.col("product_id")).alias("product_id"),
        F.when(hot, F.lit("HOT")).otherwise(F.col("state")).alias("state"),
        "date_time",
    )
    plans = {
        "pane_method": lambda: product_views(skewed),
        "window_on_clicks": lambda: views_by_window(skewed),
        "per_key_without_time": lambda: skewed.groupBy("product_id", "state").agg(F.count(F.lit(1)).alias("n")),
    }
    for name, build in plans.items():
        spark.sparkContext.setJobDescription(name)
        build().write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription("hot key share")
    hot_share = skewed.agg(F.avg(F.when((F.col("product_id") == 0) & (F.col("state") == "HOT"), 1).otherwise(0))).first()[0]
    spark.stop()
    stages = stage_shares(log_dir)
    result = {"sf_dir": sf_dir, "copies": copies, "hot_key_share_of_clicks": round(hot_share, 3), "stages": {}}
    for sid, st in sorted(stages.items()):
        result["stages"].setdefault(st.pop("label"), []).append(st)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
