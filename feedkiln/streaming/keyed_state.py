"""Keyed state as an operator (STR-3, STR-4, STR-6): ``transformWithState``.

Per post (or any key) the state store holds two variables: the last counters and
the content's time. A row is emitted when a counter differs from the stored
one, also for a key that is new; an event-time timer drops the key when the
watermark passes its time plus ``expire_after``, as the batch window filter does.
A stream can start from a saved state, a state table of the batch job or an old
JSON checkpoint (``incremental.migrate_state_json``): its rows become the keys'
first state, and unchanged posts of that state are not emitted again.

One call handles all rows that a micro-batch has for a key, Arrow batches in and
out. A hot key's rows are reduced to its newest row before the shuffle wherever
the caller can (``newest`` names the column that orders them).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from feedkiln.operators.incremental import STATE_COUNTERS, active_window, counters_differ

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_UNITS = {"day": 86400, "days": 86400, "hour": 3600, "hours": 3600, "minutes": 60, "seconds": 1}


def seconds(span: str) -> int:
    n, unit = span.split()
    return int(n) * _UNITS[unit]


class ChangedCounters(StatefulProcessor):
    """Emits keys whose counters changed; holds (counters, event time) per key."""

    def __init__(self, keys: list[str], counters: list[str], event_time: str, newest: str, expire_ms: int | None):
        self.keys, self.counters, self.event_time, self.newest, self.expire_ms = keys, counters, event_time, newest, expire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", T.StructType([T.StructField(c, T.LongType()) for c in self.counters]))
        self.began = handle.getValueState("began", T.StructType([T.StructField("ms", T.LongType())]))

    def _keep(self, counts: tuple, ms: int | None, watermark: int) -> None:
        self.last.update(counts)
        if ms is not None:
            old = self.began.get()[0] if self.began.exists() else None
            if old != ms:
                self.began.update((ms,))
                if self.expire_ms is not None:
                    if old is not None:
                        self.handle.deleteTimer(old + self.expire_ms)
                    self.handle.registerTimer(max(ms + self.expire_ms, watermark + 1))

    def _row(self, frame: pd.DataFrame) -> tuple[tuple, int | None]:
        row = frame.iloc[0]
        at = row[self.event_time]
        return tuple(int(row[c]) if pd.notna(row[c]) else 0 for c in self.counters), None if pd.isna(at) else int(pd.Timestamp(at).value // 1_000_000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() if self.expire_ms is not None else 0
        newest = None
        for frame in rows:
            top = frame.sort_values(self.newest, kind="stable").tail(1)
            if newest is None or newest[self.newest].iloc[0] <= top[self.newest].iloc[0]:
                newest = top
        counts, ms = self._row(newest)
        if self.expire_ms is not None and ms is not None and ms + self.expire_ms < watermark:
            return  # outside the window: neither kept nor told
        before = tuple(self.last.get()) if self.last.exists() else None
        if before != counts:
            yield pd.DataFrame([[*key, newest[self.event_time].iloc[0], *counts]], columns=[*self.keys, self.event_time, *self.counters])
        self._keep(counts, ms, watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        self.began.clear()
        return iter([])

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        counts, ms = self._row(initialState)
        self._keep(counts, ms, timerValues.getCurrentWatermarkInMs() if self.expire_ms is not None else 0)

    def close(self) -> None:
        pass


def changed_counters(stream: DataFrame, keys: list[str] = ["page_id", "post_id"], counters: list[str] = list(STATE_COUNTERS),  # noqa: B006
                     event_time: str = "created_time", newest: str = "ingested_at", state: DataFrame | None = None,
                     expire_after: str | None = None, late: str | None = None) -> DataFrame:
    """``keys, event_time, counters`` of new and changed keys, once per micro-batch.

    ``state`` (a table with the same columns) is the first state. The watermark
    lies on ``newest``, the snapshots' own time; ``late`` is its delay."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    schema = T.StructType([*[stream.schema[k] for k in keys], stream.schema[event_time], *[T.StructField(c, T.LongType()) for c in counters]])
    rows = stream.select(*keys, event_time, newest, *[F.col(c).cast("long").alias(c) for c in counters])
    if expire_after is not None:
        rows = rows.withWatermark(newest, late or "10 minutes")
    processor = ChangedCounters(keys, counters, event_time, newest, None if expire_after is None else seconds(expire_after) * 1000)
    first = None if state is None else state.select(*keys, event_time, *[F.col(c).cast("long").alias(c) for c in counters]).groupBy(*keys)
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Update",
        timeMode="EventTime" if expire_after is not None else "None", initialState=first)


def changed_batch(old: DataFrame, snapshot: DataFrame, keys: list[str], counters: list[str], run_ts: str, event_time: str = "created_time",
                  window_days: int | None = None) -> DataFrame:
    """The batch twin of one micro-batch: new and changed rows of a snapshot with one row per key."""
    inside = active_window(snapshot, event_time, run_ts, window_days)
    stored = old.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in counters], F.lit(True).alias("_known"))
    joined = inside.join(stored, keys, "left").filter(F.col("_known").isNull() | counters_differ(counters))
    return joined.select(*keys, event_time, *counters)


def resume_from_json(spark: SparkSession, path: str) -> DataFrame:
    """A first state from an old JSON checkpoint."""
    from feedkiln.operators import incremental
    return incremental.migrate_state_json(spark.read.text(path, wholetext=True), "value")
