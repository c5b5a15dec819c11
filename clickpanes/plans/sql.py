"""SQL surface: the derived tables as temporary views.

For users who express the jobs in Spark SQL: the operators' inputs are
registered under stable names, and SQL over them is planned by the same
optimizer as the DataFrame operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickpanes.operators.parse import click_records, click_times
from clickpanes.plans import catalog


def register_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Register ``click_lines, click_records, click_times, zip_states,
    products, categories, departments`` over the tables of ``sf_dir``."""
    lines = catalog.lines(spark, sf_dir)
    frames = {
        "click_lines": lines,
        "click_records": click_records(lines),
        "click_times": click_times(lines),
        "zip_states": catalog.zip_states(spark, sf_dir),
        "products": catalog.products(spark, sf_dir),
        "categories": catalog.categories(spark, sf_dir),
        "departments": catalog.departments(spark, sf_dir),
    }
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return frames


# The views job as SQL over the registered views (same result as
# ``views_per_state``; Spark plans the window as an expansion of each click).
VIEWS_SQL = """
WITH zs AS (SELECT DISTINCT zip_code, state FROM zip_states),
clicks AS (
  SELECT c.product_id, COALESCE(zs.state, 'Unknown') AS state, c.date_time
  FROM click_times c LEFT JOIN zs ON zs.zip_code = c.zip_code),
counted AS (
  SELECT product_id, state, window(date_time, '1 hour', '5 minutes') AS w, count(*) AS count
  FROM clicks
  GROUP BY product_id, state, window(date_time, '1 hour', '5 minutes'))
SELECT product_id, state, count, w.start AS period_start,
       CAST(date_format(w.start, 'yyyyMMddHH') AS BIGINT) AS hour
FROM counted
"""


def views_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views(spark, sf_dir)
    return spark.sql(VIEWS_SQL)
