"""Physical layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partition_count(df: DataFrame) -> int:
    """Physical partitions of ``df`` that hold rows."""
    return df.select(F.spark_partition_id().alias("partition")).distinct().count()


def physical_partitions(df: DataFrame) -> int:
    """Physical partitions of ``df``, empty ones included, as they come out of its execution."""
    return df.rdd.getNumPartitions()


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal the rows evenly over a number of partitions.

    Without a number, adaptive execution chooses one for partitions of its
    advisory size. A fixed small number squeezes a large table into few tasks.
    """
    if partitions is None:
        return df.hint("rebalance")
    return df.repartition(partitions)
