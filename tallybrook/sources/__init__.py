"""Sources."""

from tallybrook.sources.files import (
    Checked,
    file_stream,
    read_checked,
    read_files,
    read_partitioned_json,
)
from tallybrook.sources.kafka import kafka_stream
from tallybrook.sources.rows import literal_table
from tallybrook.sources.views import register_view, run_sql

__all__ = [
    "Checked",
    "file_stream",
    "kafka_stream",
    "literal_table",
    "read_checked",
    "read_files",
    "read_partitioned_json",
    "register_view",
    "run_sql",
]
