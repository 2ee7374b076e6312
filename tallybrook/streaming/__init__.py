"""Structured Streaming jobs."""

from tallybrook.streaming.bridge import bridged, start_bridge
from tallybrook.streaming.ingest import judged, start_ingest, to_dead_letters, to_documents
from tallybrook.streaming.jobs import bridge_job, ingest_job
from tallybrook.streaming.progress import ProgressLog
from tallybrook.streaming.restarts import is_transient, run_with_restarts

__all__ = [
    "ProgressLog",
    "bridge_job",
    "bridged",
    "ingest_job",
    "is_transient",
    "judged",
    "run_with_restarts",
    "start_bridge",
    "start_ingest",
    "to_dead_letters",
    "to_documents",
]
