"""Rows of a key that holds a large share of them, dealt to many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys are hot from one part in ``MOST_HOT`` of all rows on, so there are no more than that.
MOST_HOT = 20_000
LEAST_HOT = 1_000
SALTS = 64


def joined_to_key(rows: DataFrame, facts: DataFrame, key: str, counted: str) -> DataFrame:
    """``rows`` with the columns of ``facts``, which has one row for each value of ``key``.

    ``counted`` is the column of ``facts`` with the number of rows of that value. The rows
    of a hot value go to ``SALTS`` tasks and its facts to each of them. There are at
    most ``MOST_HOT`` hot values, however large the tables are, so these are broadcast.
    """
    total = facts.agg(F.sum(counted)).first()[0] or 0
    hot = facts.filter(F.col(counted) > max(LEAST_HOT, total // MOST_HOT)).select(key)
    hot = F.broadcast(hot.withColumn("hot_key", F.lit(True)))
    salts = F.when(F.col("hot_key"), SALTS).otherwise(1)
    left = rows.join(hot, key, "left").withColumn("salt_of_key", F.pmod(F.xxhash64(*rows.columns), salts.cast("long")))
    right = facts.join(hot, key, "left").withColumn("salt_of_key", F.explode(F.sequence(F.lit(0).cast("long"), salts.cast("long") - 1)))
    joined = left.drop("hot_key").join(right.drop("hot_key"), [key, "salt_of_key"])
    return joined.drop("salt_of_key")
