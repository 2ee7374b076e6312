"""In-memory rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def literal_table(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """Rows written out in the program as a table, columns named by position."""
    return spark.createDataFrame(list(rows)).toDF(*names)
