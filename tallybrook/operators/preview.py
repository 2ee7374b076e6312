"""Top rows for a report, and counts that cost no second run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def preview(df: DataFrame, order: list[Column | str], rows: int = 20) -> DataFrame:
    """The first rows by ``order``, which should be total; no full sort is done."""
    return df.orderBy(*order).limit(rows)


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and the observation of its ``num_rows``, known once ``df`` has been written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("num_rows")), seen
