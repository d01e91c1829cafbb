"""Polling a feed over HTTP: retries, the failure state machine, and a streaming data source."""

from __future__ import annotations

import logging
import random
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any, TypeVar

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

X = TypeVar("X")
log = logging.getLogger(__name__)

#: Retries of a request, waits between polls (seconds), and failures in a row that raise an alarm.
ATTEMPTS, BASE_DELAY, JITTER = 3, 1.0, 0.2
WAIT, WAIT_MOST, ALARM = 15, 300, 5


class HttpError(Exception):
    """A failed request; status is None if there was no response."""

    def __init__(self, status: int | None = None):
        super().__init__(f"HTTP {status}" if status else "no response")
        self.status = status


def worth_retrying(error: Exception) -> bool:
    """No response, too many requests, or a server's error."""
    if not isinstance(error, HttpError):
        return False
    return error.status is None or error.status == 429 or error.status >= 500


def jittered(delay: float, draw: Callable[[], float] = random.random) -> float:
    return delay * (1 - JITTER + 2 * JITTER * draw())


def with_retry(
    call: Callable[[], X],
    attempts: int = ATTEMPTS,
    base_delay: float = BASE_DELAY,
    should_retry: Callable[[Exception], bool] = worth_retrying,
    on_retry: Callable[[Exception, int, float], None] | None = None,
    sleep: Callable[[float], None] = time.sleep,
) -> X:
    """call(), again after doubling delays while it fails in a way worth retrying; the last error is raised."""
    for attempt in range(1, attempts + 1):
        try:
            return call()
        except Exception as e:
            if attempt == attempts or not should_retry(e):
                raise
            delay = jittered(base_delay * 2 ** (attempt - 1))
            if on_retry:
                on_retry(e, attempt, delay)
            sleep(delay)
    raise AssertionError("no attempts")


def connect_with_retry(call: Callable[[], X], attempts: int = 5, delay: float = 3.0, sleep: Callable[[float], None] = time.sleep) -> X:
    """call(), again after a fixed delay, whatever the error."""
    return with_retry(call, attempts, 0, lambda e: True, lambda e, n, d: sleep(delay), lambda d: None)


def fetch(url: str, get: Callable[[str], bytes | None] | None = None, **options: Any) -> bytes:
    """One snapshot's bytes; an empty body is an error."""
    body = with_retry(lambda: (get or http_get)(url), **options)
    if not body:
        raise ValueError("empty response from the feed")
    return body


def http_get(url: str) -> bytes:
    from urllib.error import HTTPError, URLError
    from urllib.request import urlopen

    try:
        with urlopen(url, timeout=10) as answer:  # noqa: S310
            return answer.read()
    except HTTPError as e:
        raise HttpError(e.code) from e
    except URLError as e:
        raise HttpError from e


def wait_seconds(failures: int) -> int:
    """The wait before the next poll after so many failures in a row."""
    return WAIT if failures < ALARM else min(WAIT * 2 ** (failures - ALARM), WAIT_MOST)


@dataclass
class Supervisor:
    """Keeps polling: each failure is logged as an error, from ALARM in a row on as critical too; success resets.

    A recovery is told only after exactly ALARM failures.
    """

    poll: Callable[[], Any]
    log: logging.Logger = field(default=log)
    failures: int = 0

    def step(self) -> int:
        """One poll; the seconds to wait before the next."""
        try:
            self.poll()
        except Exception as e:
            self.failures += 1
            self.log.error("poll failed (%d in a row): %s", self.failures, e)
            if self.failures >= ALARM:
                self.log.critical("%d polls failed in a row", self.failures)
        else:
            self.succeeded()
        return wait_seconds(self.failures)

    def succeeded(self) -> None:
        if self.failures == ALARM:
            self.log.warning("recovered after %d failures", self.failures)
        self.failures = 0

    def run(self, turns: int | None = None, sleep: Callable[[float], None] = time.sleep) -> None:
        while turns is None or turns > 0:
            wait = self.step()
            turns = None if turns is None else turns - 1
            if turns != 0:
                sleep(wait)


class FeedSource(DataSource):
    """spark.readStream.format("vehicle_feed").option("url", ...): one row with the snapshot for each trigger.

    Use with trigger(processingTime="15 seconds"). Option `fetcher` names an importable module:function in tests.
    """

    @classmethod
    def name(cls) -> str:
        return "vehicle_feed"

    def schema(self) -> str:
        return "fetched_at timestamp, content binary"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:  # noqa: N802
        return FeedReader(self.options)


class FeedReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.url, self.fetcher = options.get("url", ""), options.get("fetcher")

    def initialOffset(self) -> dict:  # noqa: N802
        return {"polls": 0}

    def read(self, start: dict) -> tuple:
        from datetime import UTC, datetime
        from importlib import import_module

        get = None
        if self.fetcher:
            module, _, name = self.fetcher.partition(":")
            get = getattr(import_module(module), name)
        body = fetch(self.url, get)
        return iter([(datetime.now(UTC), body)]), {"polls": start["polls"] + 1}

    def readBetweenOffsets(self, start: dict, end: dict):  # noqa: N802
        """A snapshot can't be fetched again; a replay polls anew, and dedup downstream takes the difference."""
        return self.read(start)[0]

    def commit(self, end: dict) -> None:
        pass


__all__ = ["ALARM", "FeedSource", "HttpError", "Supervisor", "connect_with_retry", "fetch", "jittered", "wait_seconds", "with_retry", "worth_retrying"]
