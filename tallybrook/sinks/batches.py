"""Where a streaming query puts its micro-batches."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

_QUERY_ID = "sql.streaming.queryId"


def query_id(spark: SparkSession) -> str:
    """The id of the streaming query that a batch is written for; it outlives restarts."""
    return spark.sparkContext.getLocalProperty(_QUERY_ID) or "none"


@dataclass(frozen=True)
class FolderSink:
    """One folder per query and micro-batch.

    Batches are numbered from 0 under every new checkpoint, so the query's id, which
    the checkpoint keeps, is part of the folder: another run never touches what this
    one stored. A batch is written aside, where readers do not look, and appears by
    one rename when it is complete. A replay finds it there and changes nothing.
    """

    path: str
    fmt: str = "parquet"

    def write(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = query_id(spark)
        aside = f"{self.path}/_unfinished/{query}-{batch_id}"
        batch.write.format(self.fmt).mode("overwrite").save(aside)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        source = hadoop.Path(aside)
        target = hadoop.Path(f"{self.path}/query_id={query}/batch_id={batch_id}")
        files = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        if files.exists(target):
            files.delete(source, True)
            return
        files.mkdirs(target.getParent())
        if not files.rename(source, target):
            raise OSError(f"batch {batch_id} could not be moved to {target}")


@dataclass(frozen=True)
class ConnectorSink:
    """A connector's batch writer, such as a document store or a Kafka topic.

    A replay writes the batch again, so a store should identify documents by
    their message position (``settings.document_store_options`` does).
    """

    fmt: str
    options: Mapping[str, str] = field(default_factory=dict, repr=False)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.format(self.fmt).options(**self.options).mode("append").save()
