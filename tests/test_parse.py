"""Parse rules for click lines (integer leniency, guarded timestamps)."""

import datetime as dt

import pytest

from clickpanes.operators.parse import click_records, click_times


def _one(spark, fn, line):
    df = spark.createDataFrame([(line,)], "value string")
    return fn(df).collect()


@pytest.mark.parametrize(
    "text,expected",
    [
        ("163.62515", 163),
        ("-3.9", -3),
        (".5", 0),
        ("5.", 5),
        ("42", 42),
        (" 7 ", 7),
        ("+8", 8),
        ("1e3", None),
        ("\x017\x7f", 7),
        ("\x007\x00", 7),
        ("7\x85", None),
        ("\xa07", None),
        ("x", None),
        ("", None),
        (".", None),
    ],
)
def test_product_id_leniency(spark, text, expected):
    rows = _one(spark, click_records, f"1|{text}|10001|1.5|2.5|2020/04/26 22:02:06")
    assert rows[0]["product_id"] == expected


def test_missing_fields_are_null(spark):
    r = _one(spark, click_records, "a|b")[0]
    assert r["customer_id"] is None and r["product_id"] is None
    assert r["zip_code"] is None and r["browser_x_pos"] is None and r["date_time"] is None


def test_extra_field_ignored_and_types(spark):
    df = click_records(spark.createDataFrame([(7, "4217|908|30412|77.25|1e3|2022/11/05 07:08:09|extra")], "offset long, value string"))
    assert [f.name for f in df.schema.fields] == [
        "offset", "customer_id", "product_id", "browser_x_pos", "browser_y_pos", "date_time", "zip_code",
    ]
    assert [f.dataType.simpleString() for f in df.schema.fields] == [
        "bigint", "bigint", "bigint", "float", "float", "string", "int",
    ]
    r = df.collect()[0]
    assert (r.offset, r.customer_id, r.product_id, r.zip_code) == (7, 4217, 908, 30412)
    assert r.browser_y_pos == 1000.0 and r.date_time == "2022/11/05 07:08:09"


def test_fractional_product_and_whole_position(spark):
    r = _one(spark, click_records, "52|88.0625|44071|640.5|871|2022/11/05 07:08:09")[0]
    assert r.product_id == 88 and r.zip_code == 44071 and r.browser_y_pos == 871.0


def test_zip_overflow_and_bad_float(spark):
    r = _one(spark, click_records, "1|2|99999999999|abc|1e3|2020/04/26 22:02:06")[0]
    assert r.zip_code is None and r.browser_x_pos is None and r.browser_y_pos == 1000.0


GOOD = dt.datetime(2020, 4, 26, 22, 2, 6)


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2020/04/26 22:02:06", GOOD),
        ("2020/04/26 9:5:6", dt.datetime(2020, 4, 26, 9, 5, 6)),
        ("  2020/04/26 22:02:06", GOOD),
        ("2020/04/26 22:02:06zz", GOOD),
        ("2020/13/40 22:02:06", None),
        ("2020/04/26 25:61:06", None),
        ("xx2020/04/26 22:02:06", None),
        ("2020/04/26 22:02:066", None),
        ("2020/04/26  22:02:06", None),
        ("n/a", None),
    ],
)
def test_click_time_rule(spark, text, expected):
    line = f"1|2|10001|1|1|{text}"
    rows = _one(spark, lambda d: click_times(d, keep_invalid=True), line)
    assert rows[0]["date_time"] == expected
    kept = _one(spark, click_times, line)
    assert len(kept) == (0 if expected is None else 1)


def test_parse_is_independent_of_ansi(spark):
    line = "x|1.5|99999999999|abc|1e3|2020/13/40 22:02:06"
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            r = _one(spark, click_records, line)[0]
            assert (r.customer_id, r.product_id, r.zip_code, r.browser_x_pos) == (None, 1, None, None)
            t = _one(spark, lambda d: click_times(d, keep_invalid=True), line)[0]
            assert t.date_time is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
