"""The two topic jobs, from settings in sections.

They need Spark's Kafka module and, for the document store, its connector.
"""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallybrook.settings import (
    POLLS_PER_BATCH,
    Sections,
    bridge_options,
    ingest_options,
    redacted,
)
from tallybrook.sinks import ConnectorSink, FolderSink, ManifestSink
from tallybrook.sources import kafka_stream
from tallybrook.streaming.bridge import start_bridge
from tallybrook.streaming.ingest import start_ingest

log = logging.getLogger(__name__)

# The next batch starts as soon as the source has enough for one.
_AT_ONCE = {"processingTime": "0 seconds"}


def bridge_job(
    spark: SparkSession,
    sections: Sections,
    checkpoint: str,
    *,
    polls_per_batch: int = POLLS_PER_BATCH,
    min_partitions: int | None = None,
    keep_key_headers: bool = False,
) -> StreamingQuery:
    """Copy the remote topic to the local one until the query is stopped."""
    source, sink = bridge_options(sections, polls_per_batch, min_partitions)
    log.info("bridge from %s to %s", redacted(source), redacted(sink))
    return start_bridge(
        kafka_stream(spark, source),
        "kafka",
        sink,
        checkpoint,
        _AT_ONCE,
        keep_key_headers=keep_key_headers,
        name="bridge",
    )


def ingest_job(
    spark: SparkSession,
    sections: Sections,
    checkpoint: str,
    *,
    polls_per_batch: int = POLLS_PER_BATCH,
    min_partitions: int | None = None,
    metrics: FolderSink | ManifestSink | None = None,
    schema: StructType | None = None,
) -> StreamingQuery:
    """Store the local topic's documents until the query is stopped."""
    source, store, dead = ingest_options(sections, polls_per_batch, min_partitions)
    log.info("ingest from %s to %s", redacted(source), redacted(store))
    return start_ingest(
        kafka_stream(spark, source),
        ConnectorSink("mongodb", store),
        ConnectorSink("kafka", dead),
        checkpoint,
        _AT_ONCE,
        metrics=metrics,
        schema=schema,
        name="ingest",
    )
