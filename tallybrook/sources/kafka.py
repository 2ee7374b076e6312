"""Topic source. Needs Spark's Kafka module on the class path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Column layout of the Kafka source with headers.
MESSAGE_SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int, "
    "headers array<struct<key: string, value: binary>>"
)


def kafka_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Messages of the topic named in ``settings.reader_options``."""
    return spark.readStream.format("kafka").options(**options).load()
