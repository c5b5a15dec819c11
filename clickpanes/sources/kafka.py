"""Kafka topic of click lines as a streaming DataFrame.

The Kafka connector is a separate package (``spark-sql-kafka-0-10``) that
must be on the cluster's classpath; every operator downstream only needs a
streaming DataFrame with a string ``value`` column, so any other source
works the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Default broker address and topic of the click stream.
DEFAULT_SERVERS = "0.0.0.0:9092"
DEFAULT_TOPIC = "product_clickstream"


def kafka_reader(
    spark: SparkSession,
    bootstrap_servers: str = DEFAULT_SERVERS,
    topic: str = DEFAULT_TOPIC,
    options: dict[str, str] | None = None,
):
    """The configured ``DataStreamReader`` (not yet loaded)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
    )
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader


def kafka_lines(
    spark: SparkSession,
    bootstrap_servers: str = DEFAULT_SERVERS,
    topic: str = DEFAULT_TOPIC,
    with_offset: bool = True,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """``offset bigint, value string`` (or just ``value``) from a topic."""
    raw = kafka_reader(spark, bootstrap_servers, topic, options).load()
    cols = ["CAST(offset AS BIGINT) AS offset"] if with_offset else []
    return raw.selectExpr(*cols, "CAST(value AS STRING) AS value")
