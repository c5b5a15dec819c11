"""Explicit schemas of every file the jobs read or write (no inference).

Fixed values: column names, order and types of the files' formats.
"""

from pyspark.sql import types as T

# Click record as recorded by the record job, in column order.
CLICK_RECORD = T.StructType(
    [
        T.StructField("offset", T.LongType(), True),
        T.StructField("customer_id", T.LongType(), True),
        T.StructField("product_id", T.LongType(), True),
        T.StructField("browser_x_pos", T.FloatType(), True),
        T.StructField("browser_y_pos", T.FloatType(), True),
        T.StructField("date_time", T.StringType(), True),
        T.StructField("zip_code", T.IntegerType(), True),
    ]
)

# Narrow click used for counting views.
CLICK_TIME = T.StructType(
    [
        T.StructField("product_id", T.LongType(), True),
        T.StructField("zip_code", T.IntegerType(), True),
        T.StructField("date_time", T.TimestampType(), True),
    ]
)

ZIP_STATE = T.StructType(
    [
        T.StructField("zip_code", T.IntegerType(), True),
        T.StructField("state", T.StringType(), True),
    ]
)

# Declared layout of the zip-code CSV file (header row present).
ZIP_STATE_CSV = T.StructType(
    [
        T.StructField("id", T.IntegerType(), True),
        T.StructField("zip_code", T.IntegerType(), True),
        T.StructField("city", T.StringType(), True),
        T.StructField("county", T.StringType(), True),
        T.StructField("state", T.StringType(), True),
    ]
)

PRODUCT = T.StructType(
    [
        T.StructField("product_id", T.IntegerType(), True),
        T.StructField("product_category_id", T.IntegerType(), True),
        T.StructField("product_name", T.StringType(), True),
        T.StructField("product_description", T.StringType(), True),
        T.StructField("product_price", T.FloatType(), True),
        T.StructField("product_image", T.StringType(), True),
    ]
)

CATEGORY = T.StructType(
    [
        T.StructField("category_id", T.IntegerType(), True),
        T.StructField("category_department_id", T.IntegerType(), True),
        T.StructField("category_name", T.StringType(), True),
    ]
)

DEPARTMENT = T.StructType(
    [
        T.StructField("department_id", T.IntegerType(), True),
        T.StructField("department_name", T.StringType(), True),
    ]
)

# Product views per state per window, partitioned by ``hour`` on disk.
PRODUCT_VIEWS = T.StructType(
    [
        T.StructField("product_id", T.LongType(), True),
        T.StructField("state", T.StringType(), True),
        T.StructField("count", T.LongType(), True),
        T.StructField("period_start", T.TimestampType(), True),
        T.StructField("hour", T.LongType(), True),
    ]
)

# Featured products report, in column order; year/month/day are the
# partition columns of the CSV layout.
REPORT = T.StructType(
    [
        T.StructField("product_id", T.LongType(), True),
        T.StructField("no_views", T.LongType(), True),
        T.StructField("category_id", T.IntegerType(), True),
        T.StructField("department_id", T.IntegerType(), True),
        T.StructField("product_name", T.StringType(), True),
        T.StructField("product_description", T.StringType(), True),
        T.StructField("product_image", T.StringType(), True),
        T.StructField("product_price", T.FloatType(), True),
        T.StructField("category_name", T.StringType(), True),
        T.StructField("department_name", T.StringType(), True),
        T.StructField("date", T.StringType(), True),
        T.StructField("day", T.IntegerType(), True),
        T.StructField("month", T.IntegerType(), True),
        T.StructField("year", T.IntegerType(), True),
    ]
)

REPORT_COLUMNS = [f.name for f in REPORT.fields]
