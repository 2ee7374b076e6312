"""Copy messages from one topic to another."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def bridged(messages: DataFrame, keep_key_headers: bool = False) -> DataFrame:
    """What is passed on: the value alone, or the key and the headers as well."""
    return messages.select(*(["key", "value", "headers"] if keep_key_headers else ["value"]))


def start_bridge(
    messages: DataFrame,
    fmt: str,
    options: Mapping[str, str],
    checkpoint: str,
    trigger: Mapping[str, object],
    *,
    keep_key_headers: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Start the copy.

    Progress is recorded after the sink has finished a batch. A Kafka sink may
    then see a batch twice after a failure, never lose one; a file sink keeps
    each batch once. Progress events carry the number of copied messages.
    """
    copied = bridged(messages, keep_key_headers).observe(
        "copied", F.count(F.lit(1)).alias("num_copied")
    )
    writer = (
        copied.writeStream.format(fmt)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
    )
    if name:
        writer = writer.queryName(name)
    return writer.start()
