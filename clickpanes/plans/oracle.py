"""DuckDB SQL equal to each registered query (the correctness oracle).

The views ``events customer nation part region`` are the shared test
tables. Sliding windows are written the textbook way, each click joined
to the ``size / slide`` window starts that cover it, which is independent
of the pane method the Spark side uses.
"""

from __future__ import annotations

from clickpanes.plans.catalog import (
    GRID_START,
    GRID_STEP_S,
    GRID_STEPS,
    HOT_ZIP,
    LATE_DAYS,
    LATE_DELAY,
    LATE_DELIVERIES,
    LATE_FROM,
    PRODUCT_BUCKETS,
    REPORT_DATE,
)
from clickpanes.sources.tables import EDGE_LINES, EDGE_ZIP_STATES, FAR_LINES

_BLANK = r"[\x00-\x20\x7f]"
_WHOLE = rf"'^{_BLANK}*([+-]?[0-9]+)(?:\.[0-9]*)?{_BLANK}*\z'"
_FRACTION = rf"'^{_BLANK}*[+-]?\.[0-9]+{_BLANK}*\z'"


def _lenient(expr: str, type_: str = "BIGINT") -> str:
    whole = f"regexp_extract({expr}, {_WHOLE}, 1)"
    return (
        f"(CASE WHEN {whole} <> '' THEN try_cast({whole} AS {type_}) "
        f"WHEN regexp_matches({expr}, {_FRACTION}) THEN 0::{type_} END)"
    )


def _values(rows) -> str:
    text = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v + "'"
    return ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows)


_EVENT_LINES = """SELECT event_id AS "offset",
         concat_ws('|', user_id::VARCHAR, regexp_extract(props, '[0-9]+', 0),
                   (10000 + user_id)::VARCHAR, value::VARCHAR, value::VARCHAR,
                   strftime(ts, '%Y/%m/%d %H:%M:%S')) AS value
  FROM events"""
_FIELDS = """fields AS (SELECT "offset", string_split(value, '|') AS a FROM lines)"""
LINES = f"""lines AS (
  {_EVENT_LINES}
  UNION ALL SELECT * FROM (VALUES {_values(EDGE_LINES)})),
{_FIELDS}"""
FAR = f"""lines AS (
  {_EVENT_LINES}
  UNION ALL SELECT * FROM (VALUES {_values(EDGE_LINES + FAR_LINES)})),
{_FIELDS}"""

RECORDS = f"""SELECT "offset",
       {_lenient('a[1]')} AS customer_id,
       {_lenient('a[2]')} AS product_id,
       try_cast(a[4] AS FLOAT) AS browser_x_pos,
       try_cast(a[5] AS FLOAT) AS browser_y_pos,
       a[6] AS date_time,
       {_lenient('a[3]', 'INTEGER')} AS zip_code
FROM fields"""

TIMES = f"""times AS (
  SELECT * FROM (
    SELECT {_lenient('a[2]')} AS product_id,
           {_lenient('a[3]', 'INTEGER')} AS zip_code,
           try_strptime(a[6], '%Y/%m/%d %H:%M:%S') AS date_time
    FROM fields) WHERE date_time IS NOT NULL)"""

ZIP_STATES = f"""zs AS (
  SELECT DISTINCT (10000 + c_custkey)::INTEGER AS zip_code, n_name AS state
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION SELECT * FROM (VALUES {_values(EDGE_ZIP_STATES)}))"""

DEV_ZIP_STATES = """zs AS (
  SELECT i::INTEGER AS zip_code, 'State ' || i::VARCHAR AS state
  FROM range(10000, 100000) r(i))"""

WITH_STATE = """cws AS (
  SELECT t.product_id, coalesce(z.state, 'Unknown') AS state, t.date_time
  FROM times t LEFT JOIN zs z ON t.zip_code = z.zip_code)"""


def _views(size_min: int = 60, slide_min: int = 5, name: str = "pv", src: str = "cws") -> str:
    n = size_min // slide_min
    return f"""{name} AS (
  SELECT product_id, state, count(*) AS count, period_start,
         strftime(period_start, '%Y%m%d%H')::BIGINT AS hour
  FROM (SELECT product_id, state,
               time_bucket(INTERVAL {slide_min} MINUTE, date_time)
                 - to_minutes(({slide_min} * i)::INTEGER) AS period_start
        FROM {src}, range({n}) r(i))
  GROUP BY product_id, state, period_start)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _day(date: str) -> int:
    return int(date.replace("-", "")) * 100


def _slice(date: str) -> str:
    d = _day(date)
    return f"""mm AS (SELECT max(minute(period_start)) AS m FROM pv WHERE hour = {d}),
sl AS (
  SELECT pv.* FROM pv, mm
  WHERE hour BETWEEN {d} AND {d + 23} AND minute(period_start) = mm.m)"""


DIMS = """products AS (
  SELECT p_partkey::INTEGER AS product_id,
         try_cast(regexp_extract(p_brand, '[0-9]+', 0) AS INTEGER) AS product_category_id,
         p_name AS product_name, p_type AS product_description,
         p_retailprice::FLOAT AS product_price, NULL::VARCHAR AS product_image
  FROM part),
categories AS (
  SELECT category_id, category_id % 5 AS category_department_id, category_name
  FROM (SELECT DISTINCT try_cast(regexp_extract(p_brand, '[0-9]+', 0) AS INTEGER) AS category_id,
                        p_brand AS category_name FROM part)),
departments AS (
  SELECT r_regionkey::INTEGER AS department_id, r_name AS department_name FROM region)"""


def _featured(date: str, order: str = "DESC", full: bool = True) -> str:
    y, m, d = (int(x) for x in date.split("-"))
    if full:
        joins = """JOIN categories c ON c.category_id = p.product_category_id
JOIN departments d ON d.department_id = c.category_department_id"""
        dept, cat, dname = "d.department_id", "c.category_name", "d.department_name"
    else:
        joins = ""
        dept, cat, dname = "NULL::INTEGER", "NULL::VARCHAR", "NULL::VARCHAR"
    return f"""SELECT t.product_id::BIGINT AS product_id, t.no_views,
       p.product_category_id AS category_id, {dept} AS department_id,
       p.product_name, p.product_description, p.product_image, p.product_price,
       {cat} AS category_name, {dname} AS department_name,
       '{date}' AS date, {d} AS day, {m} AS month, {y} AS year
FROM (SELECT product_id, sum(count)::BIGINT AS no_views FROM sl GROUP BY product_id
      ORDER BY no_views {order}, product_id NULLS FIRST LIMIT 10) t
JOIN products p ON p.product_id = t.product_id
{joins}"""


def _featured_sql(date: str, order: str = "DESC", full: bool = True) -> str:
    return _with(LINES, TIMES, ZIP_STATES, WITH_STATE, _views(), _slice(date), DIMS) + _featured(
        date, order, full
    )


def _all_days(full: bool = True, position: bool = False, anchor: str = "hour % 100 = 0") -> str:
    joins = """JOIN categories c ON c.category_id = p.product_category_id
JOIN departments d ON d.department_id = c.category_department_id"""
    absent = "NULL::INTEGER AS department_id", "NULL::VARCHAR AS category_name, NULL::VARCHAR AS department_name"
    dept, names = ("d.department_id", "c.category_name, d.department_name") if full else absent
    place = """,
       row_number() OVER (PARTITION BY t.day_key ORDER BY t.no_views DESC, t.product_id)::INTEGER AS position"""
    return f"""mmd AS (
  SELECT hour // 100 AS day_key, max(minute(period_start)) AS m
  FROM pv WHERE {anchor} GROUP BY hour // 100),
tot AS (
  SELECT pv.hour // 100 AS day_key, pv.product_id, sum(pv.count)::BIGINT AS no_views
  FROM pv JOIN mmd ON pv.hour // 100 = mmd.day_key AND minute(pv.period_start) = mmd.m
  GROUP BY pv.hour // 100, pv.product_id),
top AS (
  SELECT * FROM tot
  QUALIFY row_number() OVER (PARTITION BY day_key ORDER BY no_views DESC, product_id NULLS FIRST) <= 10)
SELECT t.product_id::BIGINT AS product_id, t.no_views,
       p.product_category_id AS category_id, {dept},
       p.product_name, p.product_description, p.product_image, p.product_price,
       {names},
       strftime(strptime(t.day_key::VARCHAR, '%Y%m%d'), '%Y-%m-%d') AS date,
       (t.day_key % 100)::INTEGER AS day, ((t.day_key // 100) % 100)::INTEGER AS month,
       (t.day_key // 10000)::INTEGER AS year{place if position else ''}
FROM top t
JOIN products p ON p.product_id = t.product_id
{joins if full else ''}"""


# A click's delivery, and the watermark that the deliveries before it leave.
_LATE = f"""tb AS (
  SELECT {_lenient('a[2]')} AS product_id,
         {_lenient('a[3]', 'INTEGER')} AS zip_code, date_time,
         least(greatest(date_diff('day', DATE '{LATE_FROM}', (date_time + delay)::DATE) // {LATE_DAYS}, 0),
               {LATE_DELIVERIES - 1}) AS delivery
  FROM (
    SELECT a, try_strptime(a[6], '%Y/%m/%d %H:%M:%S') AS date_time,
           CASE WHEN ('0x' || substr(md5({_lenient('a[1]')}::VARCHAR), 1, 8))::BIGINT % 2 = 0
                THEN INTERVAL {LATE_DELAY} ELSE INTERVAL 0 MINUTES END AS delay
    FROM fields)),
cb AS (
  SELECT t.product_id, coalesce(z.state, 'Unknown') AS state, t.date_time, t.delivery
  FROM tb t LEFT JOIN zs z ON t.zip_code = z.zip_code),
mx AS (SELECT delivery, max(date_time) AS m FROM cb GROUP BY delivery),
thr AS (
  SELECT p.delivery,
         (SELECT max(m) FROM mx WHERE mx.delivery < p.delivery) - INTERVAL 1 HOUR AS closed
  FROM (SELECT DISTINCT delivery FROM cb) p),
pairs AS (
  SELECT product_id, state, delivery, date_time,
         time_bucket(INTERVAL 5 MINUTE, date_time) - to_minutes((5 * i)::INTEGER) AS period_start
  FROM cb, range(12) r(i)),
kept AS (
  SELECT pairs.*, closed FROM pairs JOIN thr USING (delivery)
  WHERE thr.closed IS NULL OR period_start + INTERVAL 1 HOUR > thr.closed)
"""
_EVENT_ONLY = f"""lines AS ({_EVENT_LINES}),
{_FIELDS}"""
_LATE_EMITTED = """period_start + INTERVAL 1 HOUR <= (SELECT max(date_time) FROM cb) - INTERVAL 1 HOUR"""
_LATE_VIEWS = f"""SELECT product_id, state, count(*) AS count, period_start,
       strftime(period_start, '%Y%m%d%H')::BIGINT AS hour
FROM kept WHERE {_LATE_EMITTED}
GROUP BY product_id, state, period_start"""

#: Clicks whose 5-minute pane had closed when they came, counted in a window
#: that was open and is emitted: the late query has to hold some.
LATE_IN_OPEN_WINDOWS = (
    _with(_EVENT_ONLY, ZIP_STATES, _LATE)
    + f"""SELECT count(*) FROM kept
WHERE {_LATE_EMITTED} AND time_bucket(INTERVAL 5 MINUTE, date_time) + INTERVAL 5 MINUTE <= closed"""
)

_GRID = f"""grid AS (
  SELECT k.product_id, k.state, s.period_start,
         strftime(s.period_start, '%Y%m%d%H')::BIGINT AS hour
  FROM (SELECT DISTINCT product_id, state FROM pv) k,
       (SELECT unnest(generate_series(
            TIMESTAMP '{GRID_START}' + INTERVAL {GRID_STEP_S} SECOND,
            TIMESTAMP '{GRID_START}' + INTERVAL {GRID_STEP_S * (GRID_STEPS + 1)} SECOND,
            INTERVAL {GRID_STEP_S} SECOND)) AS period_start) s)"""

_BASE = (LINES, TIMES, ZIP_STATES, WITH_STATE)

ORACLE_SQL: dict[str, str] = {
    "parse_clicks": _with(FAR) + RECORDS,
    "parse_click_times": _with(LINES, TIMES) + "SELECT product_id, zip_code, date_time FROM times",
    "zip_states": _with(ZIP_STATES) + "SELECT zip_code, state FROM zs",
    "clicks_with_state": _with(*_BASE) + "SELECT product_id, state, date_time FROM cws",
    "product_views_sliding": _with(*_BASE, _views()) + "SELECT * FROM pv",
    "product_views_by_window": _with(*_BASE, _views()) + "SELECT * FROM pv",
    "sql_views": _with(*_BASE, _views()) + "SELECT * FROM pv",
    "product_views_dev": _with(LINES, TIMES, DEV_ZIP_STATES, WITH_STATE, _views(5, 1))
    + "SELECT * FROM pv",
    "product_views_stream": _with(*_BASE, _views())
    + """SELECT * FROM pv
WHERE period_start + INTERVAL 1 HOUR <= (SELECT max(date_time) FROM cws) - INTERVAL 1 HOUR""",
    "views_stream_by_hour": _with(*_BASE, _views())
    + """SELECT * FROM pv
WHERE period_start + INTERVAL 1 HOUR <= (SELECT max(date_time) FROM cws) - INTERVAL 1 HOUR""",
    "product_views_stream_late": _with(_EVENT_ONLY, ZIP_STATES, _LATE) + _LATE_VIEWS,
    "views_compacted": _with(_EVENT_ONLY, ZIP_STATES, _LATE) + _LATE_VIEWS,
    "views_stream_with_open": _with(*_BASE, _views())
    + """SELECT *, period_start + INTERVAL 1 HOUR > (SELECT max(date_time) FROM cws) - INTERVAL 1 HOUR AS provisional
FROM pv""",
    "clicks_with_state_skewed": _with(LINES, TIMES, ZIP_STATES)
    + f"""SELECT t.product_id, coalesce(z.state, 'Unknown') AS state, t.date_time
FROM times t LEFT JOIN zs z ON z.zip_code = CASE WHEN t.zip_code % 2 = 0 THEN {HOT_ZIP} ELSE t.zip_code END""",
    "csv_stream_roundtrip": _with(LINES, TIMES, DEV_ZIP_STATES, WITH_STATE, _views(5, 1))
    + """SELECT * FROM pv
WHERE period_start + INTERVAL 5 MINUTE <= (SELECT max(date_time) FROM cws) - INTERVAL 5 MINUTE""",
    "fan_out_roundtrip": _with(*_BASE)
    + """SELECT product_id, state, count(*) AS clicks,
       sum(count(*)) OVER (PARTITION BY product_id)::BIGINT AS product_clicks
FROM cws GROUP BY product_id, state""",
    "hour_slice": _with(*_BASE, _views(), _slice(REPORT_DATE)) + "SELECT * FROM sl",
    "product_totals_day": _with(*_BASE, _views(), _slice(REPORT_DATE))
    + "SELECT product_id, sum(count)::BIGINT AS no_views FROM sl GROUP BY product_id",
    "featured_top": _featured_sql(REPORT_DATE, "DESC"),
    "featured_low": _featured_sql(REPORT_DATE, "ASC"),
    "featured_products_only": _featured_sql(REPORT_DATE, "DESC", full=False),
    "featured_from_store": _featured_sql(REPORT_DATE, "DESC"),
    "featured_all_days": _with(FAR, TIMES, ZIP_STATES, WITH_STATE, _views(), DIMS, _all_days()),
    "featured_day_anchor": _with(*_BASE, _views(), DIMS, _all_days(full=False, anchor="true")),
    "view_grid": _with(*_BASE, _views(), _GRID) + "SELECT * FROM grid",
    "fill_views": _with(*_BASE, _views(), _GRID)
    + """SELECT g.product_id, g.state, coalesce(pv.count, 0)::BIGINT AS count,
       g.period_start, g.hour
FROM grid g LEFT JOIN pv ON g.product_id IS NOT DISTINCT FROM pv.product_id AND g.state = pv.state
                        AND g.period_start = pv.period_start""",
    "fill_views_positive": _with(*_BASE, _views(), _GRID)
    + """SELECT pv.* FROM pv JOIN grid g ON g.product_id IS NOT DISTINCT FROM pv.product_id
                        AND g.state = pv.state AND g.period_start = pv.period_start""",
    "backfill_rerun": _with(*_BASE, _views(), _GRID)
    + """SELECT pv.* FROM pv JOIN grid g ON g.product_id IS NOT DISTINCT FROM pv.product_id
                        AND g.state = pv.state AND g.period_start = pv.period_start""",
    "grid_series": _with(ZIP_STATES, DIMS)
    + """SELECT product_id::BIGINT AS product_id, state
FROM (SELECT DISTINCT product_id FROM products), (SELECT DISTINCT state FROM zs)
WHERE state IS NOT NULL""",
    "states_from_csv": _with(ZIP_STATES) + "SELECT DISTINCT state FROM zs",
    "stable_buckets": _with(FAR, TIMES, ZIP_STATES, WITH_STATE, _views())
    + f"""SELECT (('0x' || substr(md5(product_id::VARCHAR), 1, 8))::BIGINT % {PRODUCT_BUCKETS})::INTEGER
         AS bucket,
       sum(count)::BIGINT AS no_views, count(DISTINCT product_id) AS products
FROM pv GROUP BY 1""",
    "record_roundtrip": _with(LINES) + RECORDS,
    "report_roundtrip": _with(*_BASE, _views(), DIMS, _all_days(position=True)),
    "json_dims": _with(DIMS)
    + """SELECT p.*, c.*, d.* FROM products p
JOIN categories c ON c.category_id = p.product_category_id
JOIN departments d ON d.department_id = c.category_department_id""",
}
