"""Streaming jobs run over the events as if they were messages of a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions import header_text
from tallybrook.plans import tables
from tallybrook.scratch import scratch_folder
from tallybrook.sinks import FolderSink, ManifestSink, batches, read_batches
from tallybrook.sources import file_stream
from tallybrook.streaming import start_bridge, start_ingest

TOPIC = "events"
FILES_PER_BATCH = 1_000
_UNTIL_READ = {"availableNow": True}


def messages(spark: SparkSession, sf_dir: str, spoilt: bool = False) -> DataFrame:
    """The events in the layout of the Kafka source.

    ``spoilt`` damages the payload of the events with the lowest readings:
    cut short, not an object, followed by other text, not UTF-8.
    """
    # As a glob the path may be one file or a folder of files.
    events = file_stream(
        spark,
        f"{sf_dir}/events.parque[t]",
        "parquet",
        tables.SCHEMAS["events"],
        FILES_PER_BATCH,
    )
    payload = F.col("props").cast("binary")
    if spoilt:
        props, reading = F.col("props"), F.col("value")
        payload = (
            F.when(reading < 0.5, F.left(props, F.length(props) - 1).cast("binary"))
            .when(reading < 1.0, F.lit("5").cast("binary"))
            .when(reading < 1.5, F.concat(props, F.lit(" tail")).cast("binary"))
            .when(reading < 2.0, F.concat(F.lit(b"\xff\xfe"), props.cast("binary")))
            .otherwise(payload)
        )
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        payload.alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.lit(None).cast("array<struct<key: string, value: binary>>").alias("headers"),
    )


def stream_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message's value, copied unchanged."""
    target = scratch_folder(spark, "bridge")
    start_bridge(
        messages(spark, sf_dir),
        "parquet",
        {"path": f"{target}/out"},
        f"{target}/checkpoint",
        _UNTIL_READ,
    ).awaitTermination()
    return spark.read.parquet(f"{target}/out").select(F.col("value").cast("string").alias("value"))


def _ingested(spark: SparkSession, sf_dir: str, counted: bool = False) -> str:
    target = scratch_folder(spark, "ingest")
    start_ingest(
        messages(spark, sf_dir, spoilt=True),
        FolderSink(f"{target}/documents"),
        FolderSink(f"{target}/dead"),
        f"{target}/checkpoint",
        _UNTIL_READ,
        metrics=FolderSink(f"{target}/metrics") if counted else None,
    ).awaitTermination()
    return target


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored documents with their position and a field read from the document."""
    stored = spark.read.parquet(f"{_ingested(spark, sf_dir)}/documents")
    return stored.select(
        "topic",
        "partition",
        "offset",
        "value",
        F.variant_get("document", "$.k", "bigint").alias("k"),
    )


def stream_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters: bytes, reason and origin."""
    dead = spark.read.parquet(f"{_ingested(spark, sf_dir)}/dead")
    headers = F.col("headers")
    return dead.select(
        F.hex("value").alias("value_hex"),
        F.col("key").cast("string").alias("key"),
        "preview",
        header_text(headers, "dlq-error").alias("error"),
        header_text(headers, "dlq-origin-topic").alias("topic"),
        header_text(headers, "dlq-origin-partition").alias("partition"),
        header_text(headers, "dlq-origin-offset").alias("offset"),
    )


def stream_batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all batches together took in, stored and set aside."""
    batches = spark.read.parquet(f"{_ingested(spark, sf_dir, counted=True)}/metrics")
    return batches.agg(
        *[F.sum(name).alias(name) for name in ("num_in", "num_stored", "num_dead")]
    )


def stream_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by the manifests of their batches, and the rows that the manifests state.

    A second writer ends before its manifest, and the stored batch is replayed; neither
    shows in the result.
    """
    target = scratch_folder(spark, "committed")
    stored = ManifestSink(f"{target}/documents")
    start_ingest(
        messages(spark, sf_dir, spoilt=True),
        stored,
        ManifestSink(f"{target}/dead"),
        f"{target}/checkpoint",
        _UNTIL_READ,
    ).awaitTermination()
    documents = read_batches(spark, stored.path)
    documents.write.parquet(f"{stored.path}/data/unfinished")
    for batch in batches(spark, stored.path).select("query_id", "batch_id").toLocalIterator():
        ManifestSink(stored.path, query=batch.query_id).write(documents, batch.batch_id)
    stated = batches(spark, stored.path).agg(F.sum("num_rows").alias("rows_in_manifests"))
    found = read_batches(spark, stored.path).select("topic", "partition", "offset", "value")
    return found.withColumn("rows_in_manifests", F.lit(stated.first()[0]).cast("bigint"))


_SPOILT_SQL = """
    SELECT event_id, user_id, props,
           CASE WHEN "value" < 0.5 THEN encode(left(props, length(props) - 1))
                WHEN "value" < 1.0 THEN encode('5')
                WHEN "value" < 1.5 THEN encode(props || ' tail')
                WHEN "value" < 2.0 THEN '\\xFF\\xFE'::BLOB || encode(props)
           END AS bad,
           CASE WHEN "value" >= 1.5 AND "value" < 2.0 THEN 'not UTF-8 text'
                ELSE 'not a JSON object' END AS error
    FROM events
"""

ORACLES = {
    "stream_bridge": "SELECT props AS value FROM events",
    "stream_ingest": f"""
        SELECT '{TOPIC}' AS topic, 0 AS partition, event_id AS "offset", props AS "value",
               CAST(json_extract(props, '$.k') AS BIGINT) AS k
        FROM ({_SPOILT_SQL}) WHERE bad IS NULL
    """,
    "stream_committed": f"""
        SELECT '{TOPIC}' AS topic, 0 AS partition, event_id AS "offset", props AS "value",
               count(*) OVER () AS rows_in_manifests
        FROM ({_SPOILT_SQL}) WHERE bad IS NULL
    """,
    "stream_dlq": f"""
        SELECT hex(bad) AS value_hex, CAST(user_id AS VARCHAR) AS key,
               CASE WHEN error = 'not UTF-8 text' THEN left(hex(bad), 256)
                    ELSE left(decode(bad), 256) END AS preview,
               error, '{TOPIC}' AS topic, '0' AS partition,
               CAST(event_id AS VARCHAR) AS "offset"
        FROM ({_SPOILT_SQL}) WHERE bad IS NOT NULL
    """,
    "stream_batch_metrics": f"""
        SELECT count(*) AS num_in, count(*) - count(bad) AS num_stored, count(bad) AS num_dead
        FROM ({_SPOILT_SQL})
    """,
}
