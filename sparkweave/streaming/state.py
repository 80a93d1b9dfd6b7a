"""Custom keyed state on streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


class LatestValue(StatefulProcessor):
    """Changelog table: the last value per key by sequence; a null value deletes the key."""

    def __init__(self, key: str, sequence: str, value: str):
        self.names = (key, sequence, value)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("latest", "sequence bigint, value string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        name, seq, val = self.names
        best = self.state.get() if self.state.exists() else None
        changed = False
        for pdf in rows:
            top = pdf.loc[pdf[seq].idxmax()]
            if best is None or int(top[seq]) > best[0]:
                best, changed = (int(top[seq]), None if pd.isna(top[val]) else str(top[val])), True
        if changed:
            self.state.update(best)
            yield pd.DataFrame({name: [key[0]], seq: [best[0]], val: [best[1]]})

    def close(self) -> None:
        pass


def latest_values(stream: DataFrame, key: str, sequence: str, value: str) -> DataFrame:
    """Update-mode changelog of ``latest`` per key; deleted keys show a null value."""
    schema = f"{key} {stream.schema[key].dataType.simpleString()}, {sequence} bigint, {value} string"
    return stream.groupBy(key).transformWithStateInPandas(LatestValue(key, sequence, value), schema, "Update", "None")


class IdleTimer(StatefulProcessor):
    """Counts records per key and reports the count once event time has passed the key's idle limit."""

    def __init__(self, key: str, ts: str, idle_ms: int):
        self.key, self.ts, self.idle_ms = key, ts, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n bigint, last_ms bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, last = self.count.get() if self.count.exists() else (0, 0)
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        for pdf in rows:
            n += len(pdf)
            last = max(last, pdf[self.ts].max().value // 1_000_000)
        self.count.update((n, last))
        self.handle.registerTimer(last + self.idle_ms)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        n, last = self.count.get()
        self.count.clear()
        yield pd.DataFrame({self.key: [key[0]], "n": [n], "last_ms": [last]})

    def close(self) -> None:
        pass


def idle_counts(stream: DataFrame, key: str, ts: str, idle_seconds: int, delay: str) -> DataFrame:
    """``key, n, last_ms`` for each burst of records, emitted by a timer after ``idle_seconds`` of event time."""
    schema = f"{key} {stream.schema[key].dataType.simpleString()}, n bigint, last_ms bigint"
    return (
        stream.withWatermark(ts, delay).groupBy(key)
        .transformWithStateInPandas(IdleTimer(key, ts, idle_seconds * 1000), schema, "Append", "EventTime")
    )
