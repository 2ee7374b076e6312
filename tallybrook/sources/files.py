"""File scans, batch and streaming."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

#: How CSV is written and read so that every text comes back: blanks and line breaks
#: stay, quotes are doubled, and NULL has a mark, or it would be an empty text.
CSV_OPTIONS = {
    "header": "true",
    "nullValue": r"\N",
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
#: What stands for an empty text in the name of a folder, and Spark's own mark for NULL.
_EMPTY, _NONE = "(empty)", "__HIVE_DEFAULT_PARTITION__"
# Formats whose files name their columns.
_WITH_NAMES = ("parquet", "orc")


def read_files(
    spark: SparkSession,
    path: str | list[str],
    fmt: str,
    schema: StructType | str | None = None,
    options: Mapping[str, str] | None = None,
    check: bool = True,
) -> DataFrame:
    """Scan ``parquet``, ``orc``, ``avro``, ``json`` (lines) or ``csv`` (with header).

    Without a schema, CSV and JSON are read once more to infer it; with one, the
    columns come back in its order and with its types. Unless ``check`` is off, Parquet
    and ORC are asked for the columns of the schema first, by the footer that Spark
    infers a schema from: one file of a folder.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
        if schema is None:
            reader = reader.option("inferSchema", "true")
    if schema is not None:
        if check and fmt in _WITH_NAMES:
            _check_names(spark, path, fmt, schema)
        reader = reader.schema(schema)
    df = reader.options(**(options or {})).load(path)
    if isinstance(schema, StructType):
        # Partition columns are otherwise moved to the end.
        df = df.select(*schema.fieldNames())
    return csv_texts(df, read=True) if fmt == "csv" else df


def csv_texts(df: DataFrame, read: bool) -> DataFrame:
    r"""Texts that look like the NULL mark get one more backslash in a CSV file."""
    find, put = (r"^\\(\\+N)$", "$1") if read else (r"^(\\+N)$", r"\\$1")
    texts = [field.name for field in df.schema if isinstance(field.dataType, StringType)]
    return df.withColumns({name: F.regexp_replace(F.col(f"`{name}`"), find, put) for name in texts})


def folder_texts(df: DataFrame, columns: Sequence[str], read: bool) -> DataFrame:
    """Folder columns of text with a mark for the empty one, or without it again."""
    marks = rf"(\\*(?:\Q{_EMPTY}\E|{_NONE}))"

    def changed(name: str):
        text = F.col(f"`{name}`")
        if read:
            return F.when(text == _EMPTY, "").otherwise(F.regexp_replace(text, rf"^\\{marks}$", "$1"))
        return F.when(text == "", _EMPTY).otherwise(F.regexp_replace(text, rf"^{marks}$", r"\\$1"))

    texts = [name for name in columns if isinstance(df.schema[name].dataType, StringType)]
    return df.withColumns({name: changed(name) for name in texts})


def read_partitioned_json(
    spark: SparkSession, path: str, schema: StructType, partition_by: Sequence[str]
) -> DataFrame:
    """What ``write_partitioned_json`` wrote, with every text of the folder columns as it was."""
    return folder_texts(read_files(spark, path, "json", schema), partition_by, read=True)


@dataclass(frozen=True)
class Checked:
    """The rows of a scan that fit its schema, and what the others say in the files."""

    good: DataFrame
    damaged: DataFrame


def read_checked(
    spark: SparkSession,
    path: str | list[str],
    fmt: str,
    schema: StructType | str,
    options: Mapping[str, str] | None = None,
) -> Checked:
    """Scan ``json`` (lines) or ``csv`` (with header) and set damaged rows apart.

    A row is damaged if it cannot be parsed, has a value of another type than its column or,
    in CSV, more or fewer fields than the header. It is not among the ``good`` ones, not
    even in part; ``damaged`` has its ``record`` as it stands in the file, and the ``file``.
    In CSV an open quote takes the lines up to the next one with it; they are in
    ``record`` then. Blank lines are no rows.
    """
    if fmt not in ("json", "csv"):
        raise ValueError(f"{fmt} files have no damaged rows")
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    # A name that no column has.
    record = "_record" + "_" * max(map(len, wanted.fieldNames()), default=0)
    reader = spark.read.format(fmt).schema(StructType([*wanted.fields]).add(record, StringType()))
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=record, **(options or {}))
    rows = reader.load(path).select("*", F.col("_metadata.file_path").alias(f"{record}_file"))
    columns = [F.col(f"`{name}`") for name in wanted.fieldNames()]
    # Always true, but it has all columns read: a column that a query leaves out is not
    # parsed, and then no reason to find a row damaged.
    read = sum((column.isNull().cast("int") for column in columns), F.lit(0)) >= 0
    good = rows.filter(F.col(record).isNull() & read).select(*columns)
    damaged = rows.filter(F.col(record).isNotNull() & read).select(
        F.col(record).alias("record"), F.col(f"{record}_file").alias("file")
    )
    return Checked(csv_texts(good, read=True) if fmt == "csv" else good, damaged)


def _check_names(
    spark: SparkSession, path: str | list[str], fmt: str, schema: StructType | str
) -> None:
    """A column that a file lacks would be read as NULL throughout."""
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    there = {name.lower() for name in spark.read.format(fmt).load(path).columns}
    missing = [name for name in wanted.fieldNames() if name.lower() not in there]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")


def file_stream(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType | str,
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
) -> DataFrame:
    """New files under ``path`` as a stream.

    ``files_per_batch`` or ``bytes_per_batch`` bounds a micro-batch, as a record bound does
    for a topic; Spark takes one of the two. With the latter a file that is larger is a
    batch of its own, and otherwise no batch is.
    """
    if files_per_batch is not None and bytes_per_batch is not None:
        raise ValueError("a batch is bounded by files or by bytes, not by both")
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.load(path)
