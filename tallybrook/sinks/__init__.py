"""Sinks."""

from tallybrook.sinks.batches import ConnectorSink, FolderSink
from tallybrook.sinks.buckets import bucket_skew, join_buckets, write_bucketed
from tallybrook.sinks.files import write_files, write_partitioned_json, write_two_formats
from tallybrook.sinks.manifests import ManifestSink, batches, read_batches

__all__ = [
    "ConnectorSink",
    "FolderSink",
    "ManifestSink",
    "batches",
    "bucket_skew",
    "join_buckets",
    "read_batches",
    "write_bucketed",
    "write_files",
    "write_partitioned_json",
    "write_two_formats",
]
