"""Batches that a manifest makes visible, for storage where a rename is no commit."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallybrook.sinks.batches import query_id

_ENTRY = (
    "attempt string, fmt string, schema_json string, num_rows bigint, num_files bigint, "
    "files array<struct<path: string, bytes: bigint>>"
)


def _manifests(spark: SparkSession, path: str, below: str = "") -> DataFrame:
    """The complete manifests, one row each; those that a writer left half done don't count."""
    root = f"{path}/manifests"
    reader = spark.read.schema(f"{_ENTRY}, query_id string, batch_id bigint").option("basePath", root)
    try:
        found = reader.json(root + below)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{_ENTRY}, query_id string, batch_id bigint")
    # A line that was cut short is no JSON, so all of its fields are NULL.
    return found.filter(F.size("files") == F.col("num_files"))


@dataclass(frozen=True)
class ManifestSink:
    """One folder of data per attempt to write a batch, one manifest per finished batch.

    An attempt writes to a folder of its own, ``data/<attempt>``, that no reader lists.
    The manifest, one line with the files, their bytes and the number of rows, is
    written once and last, and nothing is renamed to make a batch visible. A replay that
    finds a manifest of its query and batch writes nothing. If two attempts both finish,
    as when a driver that was taken for dead goes on, both manifests stand and every
    reader takes the attempt with the least name, so no batch is read twice.

    Folders of attempts without a manifest are of no use once the query has gone on.
    ``query`` names the writer where Spark gives no id of a streaming query.
    """

    path: str
    fmt: str = "parquet"
    query: str | None = None

    def write(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = self.query or query_id(spark)
        below = f"/query_id={query}/batch_id={batch_id}"
        if not _manifests(spark, self.path, below).isEmpty():
            return
        attempt = uuid.uuid4().hex
        folder = f"{self.path}/data/{attempt}"
        batch.write.format(self.fmt).mode("error").save(folder)
        self._publish(spark, folder, attempt, batch.schema, f"{self.path}/manifests{below}")

    def _publish(self, spark: SparkSession, folder: str, attempt: str, schema: StructType, to: str) -> None:
        # Lists the files without opening them: the content is not asked for.
        files = spark.read.format("binaryFile").load(folder).select("path", F.col("length").alias("bytes"))
        stored = spark.read.format(self.fmt).schema(schema).load(folder)
        listed = files.agg(F.array_sort(F.collect_list(F.struct("path", "bytes"))).alias("files"))
        line = listed.select(
            F.lit(attempt).alias("attempt"),
            F.lit(self.fmt).alias("fmt"),
            F.lit(schema.json()).alias("schema_json"),
            F.lit(stored.count()).cast("bigint").alias("num_rows"),
            F.size("files").cast("bigint").alias("num_files"),
            "files",
        )
        line.coalesce(1).write.mode("append").json(to)


def batches(spark: SparkSession, path: str) -> DataFrame:
    """The batches under ``path`` that are complete, one row each, with files and counts."""
    first = Window.partitionBy("query_id", "batch_id").orderBy("attempt")
    ranked = _manifests(spark, path).withColumn("nth_attempt", F.row_number().over(first))
    return ranked.filter("nth_attempt = 1").drop("nth_attempt")


def read_batches(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """The rows of all complete batches under ``path``, by their manifests alone.

    What is read is what was complete at the call. The driver holds the names of the
    files, as it does for each scan. Without a ``schema`` the batches have to agree in
    theirs; a sink without a complete batch needs one.
    """
    found = batches(spark, path)
    kinds = found.select("fmt", "schema_json").distinct().collect()
    if not kinds:
        if schema is None:
            raise ValueError(f"{path} has no complete batch to take a schema from")
        return spark.createDataFrame([], schema)
    if len({kind.fmt for kind in kinds}) > 1 or (schema is None and len(kinds) > 1):
        raise ValueError(f"the batches of {path} differ in format or schema")
    wanted = schema or StructType.fromJson(json.loads(kinds[0].schema_json))
    files = [row.path for row in found.select(F.explode("files.path").alias("path")).toLocalIterator()]
    if not files:
        return spark.createDataFrame([], wanted)
    return spark.read.format(kinds[0].fmt).schema(wanted).load(files)
