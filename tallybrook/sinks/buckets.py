"""Tables stored by the hash of a key, so that joins on it need no exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.operators.joins import join_shared_key

#: A bucket may be this many times the mean before a join by buckets is given up.
MOST_SKEW = 4.0


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """Store ``df`` as the Parquet table ``name`` at ``path``, one sorted file per bucket.

    Tables that are to be joined need the same ``buckets`` and a key of the same type. A
    bucket is one task of each later join, so its share of the data has to suit a task.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def bucket_skew(spark: SparkSession, name: str) -> float:
    """How many times the mean the bytes of the largest bucket of a table are; 1 if it is empty.

    Buckets without a row have no file, and count as well.
    """
    # A listing: no file is opened.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(_told(spark, name, "Location"))
    bucket = F.regexp_extract("path", r"_(\d+)\.c\d+[^/]*$", 1)
    sizes = files.groupBy(bucket.alias("bucket")).agg(F.sum("length").alias("bytes"))
    most, total = sizes.agg(F.max("bytes"), F.sum("bytes")).first()
    return most * int(_told(spark, name, "Num Buckets")) / total if total else 1.0


def _told(spark: SparkSession, name: str, what: str) -> str:
    return spark.sql(f"DESCRIBE EXTENDED {name}").filter(F.col("col_name") == what).first().data_type


def join_buckets(
    spark: SparkSession, left: str, right: str, key: str, most_skew: float = MOST_SKEW
) -> DataFrame:
    """Inner join of two bucketed tables on ``key``, bucket by bucket.

    No row is shuffled. A key with a large part of all rows makes one bucket too large,
    which nothing can split while the buckets hold; with a bucket above ``most_skew`` times
    the mean the files are read without their buckets, and the join is a plain one, which
    adaptive execution splits.
    """
    sides = [spark.table(left), spark.table(right)]
    if max(bucket_skew(spark, left), bucket_skew(spark, right)) > most_skew:
        plain = [
            spark.read.schema(side.schema).parquet(_told(spark, name, "Location"))
            for name, side in zip((left, right), sides, strict=True)
        ]
        return join_shared_key(*plain, key)
    return join_shared_key(sides[0].hint("merge"), sides[1], key)

