"""Progress of running queries in the log."""

from __future__ import annotations

import logging

from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger(__name__)


class ProgressLog(StreamingQueryListener):
    """Logs the rows and observed counts of every batch; add it with ``spark.streams.addListener``."""

    def onQueryStarted(self, event) -> None:
        log.info("query %s started", event.name or event.id)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        log.info(
            "query %s batch %d: %d rows %s",
            progress.name or progress.id,
            progress.batchId,
            progress.numInputRows,
            {name: row.asDict() for name, row in progress.observedMetrics.items()},
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            log.error("query %s failed: %s", event.id, event.exception)
        else:
            log.info("query %s stopped", event.id)
