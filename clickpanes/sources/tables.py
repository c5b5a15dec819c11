"""Click lines and dimensions derived from the shared test tables.

The tables are TPC-H-like plus an ``events`` table; these functions map them
onto the clickstream data model so the jobs run on data whose size grows
with the scale factor. Every row of a table is used:

* click line: ``user_id | k of props | 10000 + user_id | value | value | ts``;
* zip -> state: ``10000 + c_custkey`` -> nation name;
* products from ``part``, categories from the brand number, departments
  from ``region``.

Cases the tables do not hold (bad and far times, missing fields, unknown and
NULL dimensions) are added as a few edge rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the derivation rules above.
ZIP_BASE = 10000
LINE_TIME_FORMAT = "yyyy/MM/dd HH:mm:ss"
DEPARTMENTS = 5

# Edge rows added to the derived tables. Offsets are negative.
EDGE_LINES = [
    (-1, "1|5|none|1.5|2.5|2024/01/15 00:30:00"),  # no zip code
    (-2, "2|7|99|1|1|2024/01/15 01:10:00"),  # unknown zip code
    (-3, "3|?|10003|1|1|2024/01/15 10:00:00"),  # no product id
    (-4, "4|9|10004|1|1|n/a"),  # no time
    (-5, "5|9|10005|1|1|2024/13/01 10:00:00"),  # no such month
    (-6, "6|9|10006"),  # too short
    (-7, "7|9|10007|1|1|2200/01/01 05:00:00"),  # an hour key beyond an int
    (-8, "8|9|9|1|1|2024/01/15 02:00:00"),  # zip code with a NULL state
]
# The last year a timestamp can be written in. Kept apart: clients that turn
# results into nanosecond timestamps cannot hold it.
FAR_LINES = [(-9, "9|9|10008|1|1|9999/12/31 00:00:00")]
EDGE_ZIP_STATES = [(9, None), (10007, "Second State"), (None, "Nowhere")]

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType(), True),
        T.StructField("ts", T.TimestampNTZType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("props", T.StringType(), True),
    ]
)


LINE_SCHEMA = T.StructType(
    [T.StructField("offset", T.LongType(), True), T.StructField("value", T.StringType(), True)]
)

# Schemas of the shared tables this package reads (no inference job).
TABLE_SCHEMAS = {
    "events": EVENTS,
    "customer": T.StructType(
        [
            T.StructField("c_custkey", T.LongType(), True),
            T.StructField("c_name", T.StringType(), True),
            T.StructField("c_nationkey", T.IntegerType(), True),
            T.StructField("c_acctbal", T.DoubleType(), True),
            T.StructField("c_mktsegment", T.StringType(), True),
        ]
    ),
    "nation": T.StructType(
        [
            T.StructField("n_nationkey", T.IntegerType(), True),
            T.StructField("n_name", T.StringType(), True),
            T.StructField("n_regionkey", T.IntegerType(), True),
        ]
    ),
    "part": T.StructType(
        [
            T.StructField("p_partkey", T.LongType(), True),
            T.StructField("p_name", T.StringType(), True),
            T.StructField("p_brand", T.StringType(), True),
            T.StructField("p_type", T.StringType(), True),
            T.StructField("p_size", T.IntegerType(), True),
            T.StructField("p_retailprice", T.DoubleType(), True),
        ]
    ),
    "region": T.StructType(
        [
            T.StructField("r_regionkey", T.IntegerType(), True),
            T.StructField("r_name", T.StringType(), True),
        ]
    ),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shared table; known tables are read with their schema, which
    spares the footer-reading job that schema inference runs."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def event_lines(events: DataFrame) -> DataFrame:
    """``offset, value``: one pipe-delimited click line per event.

    ``event_id`` plays the role of the Kafka offset. Works on batch and
    streaming DataFrames alike.
    """
    user = F.col("user_id").cast("string")
    value = F.col("value").cast("string")
    line = F.concat_ws(
        "|",
        user,
        F.regexp_extract(F.col("props"), "[0-9]+", 0),
        (F.lit(ZIP_BASE) + F.col("user_id")).cast("string"),
        value,
        value,
        F.date_format(F.col("ts"), LINE_TIME_FORMAT),
    )
    return events.select(F.col("event_id").alias("offset"), line.alias("value"))


def _inline(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few fixed rows as an inline table, whose size Spark's planner knows."""
    fields = [(f.name, f.dataType) for f in schema.fields]
    row = lambda r: F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(r, fields)])
    return spark.range(1).select(F.inline(F.array(*[row(r) for r in rows])))


def edge_lines(spark: SparkSession, far: bool = False) -> DataFrame:
    """The edge rows as ``offset, value``; ``far``: with ``FAR_LINES``."""
    return _inline(spark, EDGE_LINES + (FAR_LINES if far else []), LINE_SCHEMA)


def edge_lines_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stream of the edge rows, from files written under ``path``."""
    edge_lines(spark).coalesce(1).write.parquet(path)
    return spark.readStream.schema(LINE_SCHEMA).parquet(path)


def events_stream(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    glob: str | None = "events.parquet",
) -> DataFrame:
    """Events as a file stream: every new Parquet file under ``path`` is
    new data. By default only the shared ``events.parquet`` file of a
    scale-factor folder is read; ``glob=None`` reads every file.
    """
    reader = spark.readStream.schema(EVENTS)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def zip_states_from_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """``zip_code int, state string`` of every customer, and the edge rows."""
    own = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        (F.lit(ZIP_BASE) + F.col("c_custkey")).cast("int").alias("zip_code"),
        F.col("n_name").alias("state"),
    )
    return own.union(_inline(customer.sparkSession, EDGE_ZIP_STATES, own.schema))


def _brand_number(col: str = "p_brand"):
    return F.regexp_extract(F.col(col), "[0-9]+", 0).try_cast("int")


def products_from_part(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("int").alias("product_id"),
        _brand_number().alias("product_category_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_description"),
        F.col("p_retailprice").cast("float").alias("product_price"),
        F.lit(None).cast("string").alias("product_image"),
    )


def categories_from_part(part: DataFrame) -> DataFrame:
    return (
        part.select(_brand_number().alias("category_id"), F.col("p_brand").alias("category_name"))
        .distinct()
        .select(
            "category_id",
            (F.col("category_id") % DEPARTMENTS).alias("category_department_id"),
            "category_name",
        )
    )


def departments_from_region(region: DataFrame) -> DataFrame:
    return region.select(
        F.col("r_regionkey").cast("int").alias("department_id"),
        F.col("r_name").alias("department_name"),
    )
