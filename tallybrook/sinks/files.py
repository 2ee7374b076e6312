"""File sinks that replace their folder, or some folders below it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.sources.files import CSV_OPTIONS, csv_texts, folder_texts

# A CSV file whose texts may hold line breaks is read by one task.
_CSV_RECORDS = 1_000_000
#: Bytes of a file of JSON lines.
TARGET_BYTES = 128 * 1024 * 1024


def write_files(
    df: DataFrame, path: str, fmt: str, options: Mapping[str, str] | None = None
) -> None:
    """Write ``avro`` (needs Spark's module), ``orc``, ``parquet``, ``json`` or ``csv``."""
    if fmt == "csv":
        df = csv_texts(df, read=False)
    writer = df.write.format(fmt).mode("overwrite")
    if fmt == "csv":
        written = {key: value for key, value in CSV_OPTIONS.items() if key != "multiLine"}
        writer = writer.options(**written).option("maxRecordsPerFile", _CSV_RECORDS)
    writer.options(**(options or {})).save(path)


def records_within(df: DataFrame, target_bytes: int, partition_by: Sequence[str] = ()) -> int:
    """How many rows of ``df`` a file of JSON lines takes without growing over ``target_bytes``.

    The lines are made once to measure the longest, so that no file is too large in
    whatever order the rows come; one row alone may be. Folder columns are not part
    of a line.
    """
    kept = [F.col(f"`{name}`") for name in df.columns if name not in set(partition_by)]
    line = F.octet_length(F.to_json(F.struct(*kept))) + 1
    longest = df.agg(F.max(line)).first()[0]
    return max(1, target_bytes // longest) if longest else target_bytes


def write_partitioned_json(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    records_per_file: int | None = None,
    *,
    target_bytes: int | None = None,
    rebalance: bool = False,
    only_these: bool = False,
) -> None:
    """JSON lines in ``column=value`` folders, for ``read_partitioned_json``.

    A file has ``records_per_file`` at most, or as many as fit ``target_bytes``, for which
    ``df`` is read once before. Files are written straight from the tasks that hold
    the rows, at least one for each task and folder. With many folders these are many
    small files: ``rebalance`` then brings the rows of a folder together first, in a
    shuffle of the whole table, and adaptive execution splits a folder that holds much of
    it over several tasks. ``only_these`` replaces the folders that ``df`` has rows for and
    leaves the others as they are. In folder columns an empty text has a mark of its
    own, and texts like a mark get a backslash.
    """
    if target_bytes is not None:
        records_per_file = records_within(df, target_bytes, partition_by)
    df = folder_texts(df, partition_by, read=False)
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format("json").mode("overwrite").partitionBy(*partition_by)
    if records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    writer.option("partitionOverwriteMode", "dynamic" if only_these else "static").save(path)


def write_two_formats(
    df: DataFrame,
    columnar_path: str,
    json_path: str,
    partition_by: Sequence[str],
    records_per_file: int | None = None,
    columnar: str = "avro",
    rebalance: bool = False,
    target_bytes: int | None = None,
) -> None:
    """Columnar files, then partitioned JSON made from them.

    ``df`` is computed once; a second write of it would repeat all its work.
    """
    write_files(df, columnar_path, columnar)
    stored = df.sparkSession.read.schema(df.schema).format(columnar).load(columnar_path)
    write_partitioned_json(
        stored, json_path, partition_by, records_per_file, target_bytes=target_bytes, rebalance=rebalance
    )
