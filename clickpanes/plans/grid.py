"""Grid job: gap-free product views over a span of time stamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from clickpanes.operators.grid import fill_views, series_keys
from clickpanes.sinks import write_views


def gap_filled_views(
    views: DataFrame,
    start: str | Column,
    steps: int,
    step_s: int = 300,
    keys: DataFrame | None = None,
    positive_only: bool = False,
) -> DataFrame:
    """Every series (default: those seen in ``views``) at every stamp of
    the span, with the observed count or 0."""
    keys = series_keys(views) if keys is None else keys
    return fill_views(views, keys, start, steps, step_s, positive_only)


def backfill_grid(
    views: DataFrame,
    path: str,
    start: str | Column,
    steps: int,
    step_s: int = 300,
    keys: DataFrame | None = None,
    positive_only: bool = True,
    run: str | None = None,
) -> None:
    """Write the filled grid to an hour-partitioned store in one job. With ``run``, a second
    run of the same name replaces the first, and readers see the rows all at once."""
    write_views(gap_filled_views(views, start, steps, step_s, keys, positive_only), path, run=run)
