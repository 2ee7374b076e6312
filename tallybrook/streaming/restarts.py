"""Which failures of a streaming query pass, and going on after those."""

from __future__ import annotations

import logging
import re
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)

#: Error conditions that only say where something failed. Any other condition names a fault
#: of the query, its data or its settings, which the same batch would meet again.
_WRAPPERS = frozenset(
    "STREAM_FAILED FOREACH_BATCH_USER_FUNCTION_ERROR FOREACH_USER_FUNCTION_ERROR TASK_WRITE_FAILED FAILED_READ_FILE".split()
)
#: Exceptions of networks, stores and brokers that a later try may not meet.
_TRANSIENT = frozenset(
    "ConnectionError ConnectionResetError ConnectionRefusedError ConnectionAbortedError BrokenPipeError "
    "TimeoutError InterruptedError BlockingIOError "
    "ConnectException SocketException SocketTimeoutException NoRouteToHostException TimeoutException "
    "RetriableException RetriableCommitFailedException DisconnectException NetworkException "
    "NotEnoughReplicasException LeaderNotAvailableException CoordinatorNotAvailableException "
    "MongoSocketException MongoTimeoutException AutoReconnect NetworkTimeout ServerSelectionTimeoutError".split()
)
_CONDITION = re.compile(r"(?m)(?:^|[\s:])\[([A-Z][A-Z0-9_]+)(?:\.[A-Z0-9_]+)*\]")
# The line of a trace that names what was raised, as in "Caused by: a.b.SomeException: why".
_RAISED = re.compile(r"(?m)^(?:Caused by: )?(?:[\w$]+\.)*([A-Z]\w*)(?::|$)")


def is_transient(error: StreamingQueryException) -> bool:
    """Whether a restart may get over ``error``.

    An error condition of Spark's other than the wrappers is permanent. Else one of the
    exceptions in the message has to be known as transient; unknown ones are permanent.
    """
    text = str(error)
    conditions = set(_CONDITION.findall(text)) | {(error.getCondition() or "STREAM_FAILED").split(".")[0]}
    if conditions - _WRAPPERS:
        return False
    return not _TRANSIENT.isdisjoint(_RAISED.findall(text))


def run_with_restarts(
    start: Callable[[], StreamingQuery],
    most: int = 3,
    wait: float = 1.0,
    transient: Callable[[StreamingQueryException], bool] = is_transient,
) -> int:
    """Run the query of ``start`` until it ends by itself; the number of restarts.

    After a transient failure it is started again, from its checkpoint, after ``wait``
    seconds that double each time. After ``most`` failures in a row without a finished
    batch between them, and after any other failure, the error is raised.
    """
    restarts = failures = 0
    while True:
        query = start()
        try:
            query.awaitTermination()
            return restarts
        except StreamingQueryException as error:
            if query.lastProgress is not None:
                failures = 0
            failures += 1
            if failures > most or not transient(error):
                log.error("query %s stopped for good: %s", query.name or query.id, error.getCondition())
                raise
            restarts += 1
            log.warning("query %s starts again, restart %d", query.name or query.id, restarts)
            time.sleep(wait * 2 ** (failures - 1))
