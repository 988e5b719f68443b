"""A circuit breaker by host over a stream of responses: state with timers.

Failures count up while they follow one another; 401, 403 and 429 pause the host. Nothing but time ends a
pause, so each pause sets a timer of event time; a host that has been quiet for long is forgotten by a timer
as well (state with a time to live goes by the clock, and a replay would forget what the first run knew).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampType

#: Statuses that pause a host, minutes of a pause for each failure so far, and the most (fixed values).
PAUSING, MINUTES, MOST_MINUTES = (401, 403, 429), 2, 20
OUTPUT = StructType([StructField("host", StringType()), StructField("ts", TimestampType()), StructField("status", IntegerType()), StructField("failures", IntegerType()), StructField("blocked_until", TimestampType()), StructField("kind", StringType())])
STATE = StructType([StructField("failures", IntegerType()), StructField("until_ms", LongType()), StructField("last_ms", LongType())])


def step(failures: int, status: int, at_ms: int) -> tuple[int, int]:
    """Failures and end of the pause (0: none) after one response. Any status from 400 on is a failure; one below ends the count."""
    if status < 400:
        return 0, 0
    failures += 1
    return failures, at_ms + 60_000 * min(MOST_MINUTES, MINUTES * failures) if status in PAUSING else 0


class Breaker(StatefulProcessor):
    """Rows out: allowed and refused responses (refused: a request while its host is paused, which changes nothing), and a row "reopened" where a pause ends."""

    def __init__(self, quiet_ms: int) -> None:
        self.quiet_ms = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("pause", STATE)

    def _now(self) -> tuple[int, int, int]:
        return tuple(self.state.get()) if self.state.exists() else (0, 0, 0)

    @staticmethod
    def _time(ms: int):
        return pd.Timestamp(ms, unit="ms") if ms else pd.NaT

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        failures, until, last = self._now()
        out = []
        batch = pd.concat(list(rows)).sort_values(["ts", "status"], kind="stable")
        for ts, status in zip(batch["ts"], batch["status"], strict=True):
            at = int(pd.Timestamp(ts).value // 1_000_000)
            last = max(last, at)
            if until and at < until:
                out.append((key[0], ts, status, failures, self._time(until), "refused"))
                continue
            before = until
            failures, until = step(failures, int(status), at)
            if until and until != before:
                self.handle.registerTimer(until)
            out.append((key[0], ts, status, failures, self._time(until), "allowed"))
        self.state.update((failures, until, last))
        self.handle.registerTimer(last + self.quiet_ms)
        yield pd.DataFrame(out, columns=OUTPUT.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        failures, until, last = self._now()
        at = expiredTimerInfo.getExpiryTimeInMs()
        if at == last + self.quiet_ms:
            self.state.clear()
        elif until and until == at:  # a later pause has a timer of its own
            self.state.update((failures, 0, last))
            yield pd.DataFrame([(key[0], self._time(at), None, failures, pd.NaT, "reopened")], columns=OUTPUT.names).astype({"status": "Int32"})

    def close(self) -> None:
        pass


def circuit_breaker(responses: DataFrame, delay: str = "1 minute", quiet_hours: int = 48) -> DataFrame:
    """A stream of (host, ts, status) to what was allowed, refused and reopened. The session's state store has to be RocksDB's."""
    own = responses.select("host", "ts", "status").where("host is not null and ts is not null and status is not null").withWatermark("ts", delay)
    return own.groupBy("host").transformWithStateInPandas(Breaker(quiet_hours * 3_600_000), OUTPUT, "Append", "EventTime")
