"""Session factory. Library code never builds a session; it uses the caller's."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pyspark
from pyspark.sql import SparkSession

_SCALA = "2.13"


def package_coordinates(*names: str) -> str:
    """Maven coordinates of Spark's own optional modules, for the running version."""
    modules = {"avro": "spark-avro", "kafka": "spark-sql-kafka-0-10"}
    return ",".join(
        f"org.apache.spark:{modules[name]}_{_SCALA}:{pyspark.__version__}" for name in names
    )


def engine_settings(shuffle_bytes: int | None = None) -> dict[str, str]:
    """Settings the operators are written for.

    ``shuffle_bytes`` is the expected size of the largest shuffle. Adaptive
    execution can merge small shuffle partitions but cannot add any to a plain
    shuffle, so the initial number has to suit the largest one.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        # Splits a hot join key's partition by map output, copies included, and
        # does so even where that costs the plan another exchange.
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # A repeated JSON key keeps its last value instead of making the text invalid.
        "spark.sql.variant.allowDuplicateKeys": "true",
    }
    if shuffle_bytes is not None:
        target = 128 * 1024 * 1024
        partitions = max(200, -(-shuffle_bytes // target))
        settings["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(target)
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(partitions)
    return settings


def build_session(
    app_name: str,
    master: str | None = None,
    packages: Iterable[str] = (),
    shuffle_bytes: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> SparkSession:
    """Get or create a session; the master is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = engine_settings(shuffle_bytes)
    if packages:
        settings["spark.jars.packages"] = package_coordinates(*packages)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
