"""Named tables and SQL text."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` known to SQL in this session, replacing a view of that name."""
    df.createOrReplaceTempView(name)
    return df


def run_sql(
    spark: SparkSession, text: str, args: Mapping[str, Any] | None = None, **frames: DataFrame
) -> DataFrame:
    """Run SQL with ``:name`` parameters over ``{name}`` frames."""
    return spark.sql(text, args=dict(args or {}), **frames)
