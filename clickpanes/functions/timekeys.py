"""Time keys: hour partition key, panes and sliding-window starts.

Window arithmetic runs on epoch microseconds, the unit Spark's own
``window`` function uses, so windows here line up with ``F.window``.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column
from pyspark.sql import functions as F

_US = 1_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_key(ts: Column | str) -> Column:
    """``yyyyMMddHH`` of a timestamp as a bigint (e.g. 2024011513). An int
    ends in the year 2147; bigint arithmetic holds every timestamp, with
    ANSI mode on or off."""
    ts = _col(ts)
    return (
        F.year(ts).cast("bigint") * 1_000_000
        + F.month(ts) * 10_000
        + F.dayofmonth(ts) * 100
        + F.hour(ts)
    )


def pane_seconds(size_s: int, slide_s: int) -> int:
    """Largest span whose events all fall into the same sliding windows."""
    return gcd(size_s, slide_s)


def pane_start(ts: Column | str, pane_s: int) -> Column:
    """Start of the ``pane_s``-second pane holding ``ts``, as epoch micros."""
    us = F.unix_micros(_col(ts))
    return us - F.pmod(us, F.lit(pane_s * _US))


def first_stamp(start: Column, step_s: int) -> Column:
    """Epoch microseconds of the stamp one step after ``start`` (truncated to whole seconds)."""
    return F.unix_micros(F.date_trunc("second", start)) + F.lit(step_s * _US)


def stamps_after(start: Column, steps: int, step_s: int) -> Column:
    """``steps + 1`` timestamps ``step_s`` seconds of elapsed time apart, the first one step after
    ``start`` (truncated to whole seconds)."""
    first = first_stamp(start, step_s)
    return F.transform(F.sequence(F.lit(0), F.lit(steps)), lambda k: F.timestamp_micros(first + k.cast("bigint") * F.lit(step_s * _US)))


def grid_start(now, steps: int, step_s: int, start_delta_s: int = -1):
    """Start of a stamp grid ending near ``now`` (a ``datetime``):
    ``steps * step_s`` seconds before ``now`` when ``start_delta_s`` is
    negative, else ``start_delta_s`` seconds before it. With the default
    the ``steps + 1`` stamps of ``stamps_after`` end one step after
    ``now``. "Now" is an argument, so a run is repeatable."""
    import datetime as _dt

    back = steps * step_s if start_delta_s < 0 else start_delta_s
    return (now - _dt.timedelta(seconds=back)).replace(microsecond=0)
