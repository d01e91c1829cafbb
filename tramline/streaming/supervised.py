"""Keeping a streaming query alive, and telling what each of its cycles did."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tramline.sources.polling import Supervisor

log = logging.getLogger(__name__)


def log_to(path: str, logger: logging.Logger = logging.getLogger("tramline"), level: int = logging.INFO) -> None:
    """Sends the library's log to the console and to a file, a line for each message with its time and level."""
    form = logging.Formatter("%(asctime)s %(levelname)s %(name)s %(message)s")
    for handler in (logging.StreamHandler(), logging.FileHandler(path)):
        handler.setFormatter(form)
        logger.addHandler(handler)
    logger.setLevel(level)


class CycleLog(StreamingQueryListener):
    """Logs each micro-batch of the queries that live.counted watches: published and skipped rows, and how long it took.

    Use with spark.streams.addListener.
    """

    def __init__(self, name: str = "cycle", logger: logging.Logger = log):
        self.name, self.logger = name, logger

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.logger.info("query %s started", event.name or event.id)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        if self.name in p.observedMetrics:
            row = p.observedMetrics[self.name]
            self.logger.info("batch %d: published %d, skipped %d, %d ms", p.batchId, row["published"], row["skipped"], p.durationMs.get("triggerExecution", 0))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if event.exception:
            self.logger.error("query %s failed: %s", event.id, event.exception)
        else:
            self.logger.info("query %s ended", event.id)


def supervised(start: Callable[[], StreamingQuery], sleep: Callable[[float], None] = time.sleep, logger: logging.Logger = log, turns: int | None = None) -> Supervisor:
    """Starts a query, and starts it again whenever it fails, from its own checkpoint; returns when it ends without an error.

    Waits and alarms are those of polling.Supervisor. A query that finished a batch before it failed had recovered, so
    its failure is the first in a row. turns: starts at most.
    """

    def poll() -> None:
        query = start()
        try:
            query.awaitTermination()
        except Exception:
            if query.recentProgress:
                keeper.succeeded()
            raise

    keeper = Supervisor(poll, logger)
    while turns is None or turns > 0:
        wait = keeper.step()
        if keeper.failures == 0:
            break
        turns = None if turns is None else turns - 1
        if turns != 0:
            sleep(wait)
    return keeper
