"""Status changes of tickets, followed event by event.

State per ticket: the status it has, and the events that are not old enough
to be sure that none comes before them.  An event leaves the state when the
watermark has passed it, in the order of time and id, whatever the order of
arrival.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

LATENESS = "1 hour"
EVENT = "event_id string, ticket_id string, event_ts timestamp, old_status string, new_status string"
MOVE = EVENT + ", known_status string, is_first boolean, is_broken boolean"
_ORDER = ["event_ts", "event_id"]
_CELLS = ["event_id", "event_ts", "old_status", "new_status"]
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def moves(events: DataFrame) -> DataFrame:
    """The same on a table: each event with the status that the event before it left.

    ``is_broken`` says that ``old_status`` is not that status; a first event
    is broken if it comes from any status.  Of one time, events go by id.
    """
    order = f"OVER (PARTITION BY ticket_id ORDER BY {', '.join(_ORDER)})"
    known, first = F.expr(f"lag(new_status) {order}"), F.expr(f"row_number() {order} = 1")
    return events.withColumns({"known_status": known, "is_first": first}).withColumn(
        "is_broken", ~F.col("old_status").eqNullSafe(F.col("known_status"))
    )


class _Follow(StatefulProcessor):
    """Keeps ``status`` (what the last event that left set) and ``waiting`` (events not yet sure)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.status = handle.getValueState("status", "known boolean, status string, due long")
        columns = "event_id array<string>, event_us array<long>, old_status array<string>, new_status array<string>"
        self.waiting = handle.getValueState("waiting", columns)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        held = [self._held(), *rows]
        events = pd.concat([h[_CELLS] for h in held if len(h)], ignore_index=True)
        yield from self._leave(key, events, timerValues)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        events = self._held()
        if len(events):
            yield from self._leave(key, events, timerValues, expiredTimerInfo.getExpiryTimeInMs())

    def close(self) -> None:
        pass

    def _held(self) -> pd.DataFrame:
        found = self.waiting.get() if self.waiting.exists() else None
        if found is None:
            return pd.DataFrame(columns=_CELLS)
        ids, times, old, new = (list(c) for c in found)
        at = pd.to_datetime(pd.Series(times, dtype="int64"), unit="us")
        return pd.DataFrame({"event_id": ids, "event_ts": at, "old_status": old, "new_status": new})

    def _leave(self, key: Any, events: pd.DataFrame, timers: Any, fired: int = 0) -> Iterator[pd.DataFrame]:
        events = events.sort_values(_ORDER, kind="stable", ignore_index=True)
        at = events["event_ts"].astype("datetime64[us]").astype("int64")
        sure = at // 1000 < timers.getCurrentWatermarkInMs()
        known, status, due = self.status.get() if self.status.exists() else (False, None, 0)
        done, left = events[sure], events[~sure]
        if len(done):
            before = [status, *done["new_status"].iloc[:-1]]
            out = done.assign(ticket_id=key[0], known_status=before)
            out["is_first"] = [not known] + [False] * (len(done) - 1)
            same = [(o == k) or (pd.isna(o) and pd.isna(k)) for o, k in zip(done["old_status"], before)]
            out["is_broken"] = [not s for s in same]
            known, status = True, done["new_status"].iloc[-1]
            yield out[["event_id", "ticket_id", "event_ts", "old_status", "new_status", "known_status", "is_first", "is_broken"]]
        if len(left):
            cells = [None if pd.isna(v) else v for v in left["old_status"]], [None if pd.isna(v) else v for v in left["new_status"]]
            self.waiting.update((left["event_id"].tolist(), at[~sure].tolist(), *cells))
            first = int(at[~sure].iloc[0]) // 1000 + 1
            if first != due or fired == due:
                self.handle.registerTimer(first)
                due = first
        elif self.waiting.exists():
            self.waiting.clear()
        self.status.update((bool(known), None if pd.isna(status) else status, int(due)))


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """The state store that keyed processors need, for queries started inside."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_STORE, before) if before is not None else spark.conf.unset(_STORE)


def followed(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """A stream of events (EVENT) as a stream of moves (MOVE).

    Events without ticket, id or time are left out, on the stream as on the
    table.  Events that are later than ``lateness`` allows are dropped by
    Spark; the newest ones wait in the state until the watermark passes them.
    """
    rows = events.where("ticket_id IS NOT NULL AND event_id IS NOT NULL AND event_ts IS NOT NULL")
    return (
        rows.withWatermark("event_ts", lateness)
        .groupBy("ticket_id")
        .transformWithStateInPandas(_Follow(), MOVE, outputMode="Append", timeMode="EventTime")
    )


def stream_moves(
    spark: SparkSession,
    events: str,
    out: str,
    checkpoint: str,
    lateness: str = LATENESS,
    trigger: dict | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start following a folder of Parquet files of events, appending moves to ``out``."""
    reader = spark.readStream.schema(EVENT)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    with keyed_state(spark):
        return (
            followed(reader.parquet(events), lateness)
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )


def broken_moves(moved: DataFrame) -> DataFrame:
    """How often a status was claimed that the ticket did not have."""
    return (
        moved.where("is_broken")
        .groupBy("known_status", "old_status")
        .agg(F.count("*").alias("events"), F.countDistinct("ticket_id").alias("tickets"))
    )
