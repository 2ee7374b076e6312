"""Store JSON messages as documents; keep what is not one as a dead letter."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallybrook.functions import (
    as_text,
    flat_document,
    is_document,
    json_values,
    over_parser_limits,
)
from tallybrook.sinks.batches import ConnectorSink, FolderSink
from tallybrook.sinks.manifests import ManifestSink

log = logging.getLogger(__name__)

Sink = FolderSink | ManifestSink | ConnectorSink

_TEXT, _VALUES, _FAULT, _DOCUMENT = "text", "json_values", "fault", "document"
_POSITION = ["topic", "partition", "offset"]
_PREVIEW_LENGTH = 256
_COUNTS = ["num_in", "num_stored", "num_dead"]
_COUNTS_TYPE = ", ".join(f"{name} bigint" for name in _COUNTS)


def judged(messages: DataFrame, variant: bool = True) -> DataFrame:
    """Add ``fault`` and, if wanted, ``document``.

    ``fault`` says why a message is not a document, or is NULL. Needs
    ``spark.sql.variant.allowDuplicateKeys`` for objects with repeated keys.
    """
    value, text, values = F.col("value"), F.col(_TEXT), F.col(_VALUES)
    fault = (
        F.when(value.isNull(), "no value")
        .when(text.isNull(), "not UTF-8 text")
        .when(
            ~is_document(text, values),
            F.when(over_parser_limits(text), "beyond the limits of the JSON parser").otherwise(
                "not a JSON object"
            ),
        )
    )
    # One projection per step, so that each text is decoded and parsed once.
    parsed = messages.withColumn(_TEXT, as_text(value)).withColumn(_VALUES, json_values(text))
    added = {_FAULT: fault}
    if variant:
        added[_DOCUMENT] = F.get(values, 0)
    return parsed.withColumns(added).drop(_TEXT, _VALUES)


def to_documents(checked: DataFrame, schema: StructType | None = None) -> DataFrame:
    """Sound messages with their position.

    With a schema its fields become columns, and only they are stored; a value of
    another type becomes NULL. Without one there is the whole text, and
    beside it the document as VARIANT if it was kept. The text stays because
    VARIANT numbers can lose digits.
    """
    sound = checked.filter(F.col(_FAULT).isNull())
    text = as_text(F.col("value"))
    if schema is None:
        kept = [_DOCUMENT] if _DOCUMENT in checked.columns else []
        return sound.select(*_POSITION, text.alias("value"), *kept)
    clash = set(_POSITION) & set(schema.fieldNames())
    if clash:
        raise ValueError(f"document fields {sorted(clash)} are names of the message position")
    typed = sound.select(*_POSITION, F.from_json(text, schema).alias("fields"))
    return typed.select(*_POSITION, "fields.*")


def to_flat_documents(checked: DataFrame) -> DataFrame:
    """Sound messages as lines of JSON in ``value``, for a text sink.

    Each is the object itself, with the message position as its field ``_position``.
    """
    sound = checked.filter(F.col(_FAULT).isNull())
    position = F.struct(*_POSITION)
    return sound.select(flat_document(as_text(F.col("value")), position).alias("value"))


def to_dead_letters(checked: DataFrame) -> DataFrame:
    """Faulty messages: key and value as they came, the reason and origin as headers.

    There is no topic or partition column, which a Kafka sink would obey.
    """
    def header(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("key"), value.cast("string").cast("binary").alias("value"))

    added = F.array(
        header("dlq-error", F.col(_FAULT)),
        header("dlq-origin-topic", F.col("topic")),
        header("dlq-origin-partition", F.col("partition")),
        header("dlq-origin-offset", F.col("offset")),
    )
    kept = F.coalesce(
        F.col("headers"), F.array().cast("array<struct<key: string, value: binary>>")
    )
    shown = F.coalesce(as_text(F.col("value")), F.hex("value"))
    return checked.filter(F.col(_FAULT).isNotNull()).select(
        "key",
        "value",
        F.concat(kept, added).alias("headers"),
        F.left(shown, F.lit(_PREVIEW_LENGTH)).alias("preview"),
    )


@contextmanager
def _session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def start_ingest(
    messages: DataFrame,
    documents: Sink,
    dead_letters: Sink,
    checkpoint: str,
    trigger: Mapping[str, object],
    *,
    metrics: FolderSink | ManifestSink | None = None,
    schema: StructType | None = None,
    flat: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Start storing.

    ``flat`` stores JSON lines that are the objects themselves and their position, for a
    sink of format ``text``; otherwise ``schema`` says what the documents' columns are.

    A batch counts as done only after all its outputs are written; if one fails
    the query stops, and a restart writes the same batch under the same id.
    ``metrics`` receives one row per batch with what came in and where it went.
    """

    # Connectors have no VARIANT type.
    variant = schema is None and not flat and isinstance(documents, FolderSink | ManifestSink)
    if flat and (schema is not None or documents.fmt != "text"):
        raise ValueError("flat documents are lines of text without a schema")

    def store(batch: DataFrame, batch_id: int) -> None:
        # All outputs come from one read and one parse of the batch.
        needed = batch.select(*_POSITION, "key", "value", "headers")
        checked = judged(needed, variant).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            dead_letters.write(to_dead_letters(checked), batch_id)
            made = to_flat_documents(checked) if flat else to_documents(checked, schema)
            documents.write(made, batch_id)
            # A sink that has the batch already reads nothing, so its write can't be observed.
            counts = checked.agg(
                F.count(F.lit(1)).alias("num_in"),
                F.count_if(F.col(_FAULT).isNull()).alias("num_stored"),
                F.count_if(F.col(_FAULT).isNotNull()).alias("num_dead"),
            ).first()
            if metrics is not None:
                row = tuple(counts[name] for name in _COUNTS)
                metrics.write(batch.sparkSession.createDataFrame([row], _COUNTS_TYPE), batch_id)
        finally:
            checked.unpersist()
        log.info(
            "batch %d: stored %d of %d messages, %d dead letters",
            batch_id,
            counts["num_stored"],
            counts["num_in"],
            counts["num_dead"],
        )

    writer = (
        messages.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
    )
    if name:
        writer = writer.queryName(name)
    # The query copies the session's settings when it starts.
    with _session_setting(messages.sparkSession, "spark.sql.variant.allowDuplicateKeys", "true"):
        return writer.start()
