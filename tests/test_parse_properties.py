"""Parse rules against a plain-Python model of them, on generated text."""

import datetime as dt
import re

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st

from clickpanes.functions import click_time, lenient_integer

INT64 = (-(2**63), 2**63 - 1)
INT32 = (-(2**31), 2**31 - 1)


def model_integer(text, bounds):
    if text is None:
        return None
    m = re.fullmatch(r"[\x00-\x20\x7f]*([+-]?[0-9]+)(?:\.[0-9]*)?[\x00-\x20\x7f]*", text)
    if m:
        v = int(m.group(1))
        return v if bounds[0] <= v <= bounds[1] else None
    if re.fullmatch(r"[\x00-\x20\x7f]*[+-]?\.[0-9]+[\x00-\x20\x7f]*", text):
        return 0
    return None


SHAPE = r"^[ \t]*([0-9]{4})/([0-9]{2})/([0-9]{2}) ([0-9]{1,2}):([0-9]{1,2}):([0-9]{1,2})(?![0-9])"


def model_time(text):
    m = re.match(SHAPE, text)
    if not m:
        return None
    y, mo, d, h, mi, s = (int(g) for g in m.groups())
    try:
        return dt.datetime(y, mo, d, h, mi, s)
    except ValueError:
        return None


numberish = st.text(alphabet="0123456789+-. \te\x00\x01\x1f\x7f\x85\xa0", max_size=12)
digits = st.integers(min_value=0, max_value=10**20).map(str)


def _field(n, width_choice):
    return st.builds(lambda v, two: f"{v:02d}" if two else str(v), n, width_choice)


times = st.builds(
    lambda lead, y, mo, d, h, mi, s, tail: f"{lead}{y:04d}/{mo:02d}/{d:02d} {h}:{mi}:{s}{tail}",
    st.sampled_from(["", " ", "  ", "\t", "x"]),
    st.integers(1990, 2030),
    st.integers(0, 13),
    st.integers(0, 32),
    _field(st.integers(0, 25), st.booleans()),
    _field(st.integers(0, 61), st.booleans()),
    _field(st.integers(0, 61), st.booleans()),
    st.sampled_from(["", "zz", ".5", "5", " x"]),
)

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.too_slow])


@SETTINGS
@given(st.lists(st.one_of(numberish, digits), min_size=20, max_size=120))
def test_lenient_integer_matches_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", lenient_integer("t").alias("l"), lenient_integer("t", "int").alias("i")).collect()
    for r in got:
        assert r.l == model_integer(r.t, INT64), r
        assert r.i == model_integer(r.t, INT32), r


@SETTINGS
@given(st.lists(times, min_size=20, max_size=120))
def test_click_time_matches_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", click_time("t").alias("ts")).collect()
    for r in got:
        assert r.ts == model_time(r.t), r
