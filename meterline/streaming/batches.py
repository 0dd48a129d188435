"""Batching of event streams: a batch closes when it is full or its time is up, whichever comes first.

Each feed (key) has one open batch in keyed state. Its time starts with its
first event and starts anew with the next batch, also when the one before was
full early. A timer closes a batch that no further event comes to. The state
of a feed is its open batch alone, so it is as large as a batch may be.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from meterline.session import ship_package
from meterline.streaming.events import BATCH_BYTES

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: An open batch, and the micros of its first and latest event.
OPEN = "batch_no bigint, first_us bigint, last_us bigint, n_bytes bigint"
BATCHES = "feed string, batch_no bigint, opened_at timestamp, last_at timestamp, closed_by string, n_events bigint, n_bytes bigint, event_ids array<string>"
FULL, TIME = "size", "time"


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state with timers needs this store; set before the query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _moment(micros: int) -> datetime:
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)


class Batcher(StatefulProcessor):
    def __init__(self, max_bytes: int, max_micros: int):
        self.max_bytes, self.max_micros = max_bytes, max_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", OPEN)
        self.ids = handle.getListState("ids", "id string")

    def close(self) -> None:
        pass

    def _closed(self, feed: str, state: tuple, ids: list[str], by: str) -> dict:
        number, first, last, n_bytes = state
        return dict(feed=feed, batch_no=number, opened_at=_moment(first), last_at=_moment(last), closed_by=by, n_events=len(ids), n_bytes=n_bytes, event_ids=ids)

    def _load(self) -> tuple[tuple, list[str]]:
        """The open batch, or the place of the next one (no events yet), with the ids in it."""
        if not self.open.exists():
            return (0, None, None, 0), []
        state = tuple(self.open.get())
        return state, [row[0] for row in self.ids.get()] if self.ids.exists() else []

    def _store(self, state: tuple, ids: list[str]) -> None:
        """Keeps the open batch and sets its one timer."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        number, first, last, n_bytes = state
        if ids:
            self.open.update((number, first, last, n_bytes))
            self.ids.put([(i,) for i in ids])
            self.handle.registerTimer(-(-(first + self.max_micros) // 1000))
        else:  # only the number goes on
            self.open.update((number, -1, -1, 0))
            self.ids.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        feed, (state, ids), done = key[0], self._load(), []
        events = pd.concat(list(rows), ignore_index=True)
        for event_id, at, size in events.sort_values(["at_us", "event_id"], kind="stable")[["event_id", "at_us", "size"]].itertuples(index=False):
            number, first, last, n_bytes = state
            if ids and at >= first + self.max_micros:
                done.append(self._closed(feed, state, ids, TIME))
                number, ids = number + 1, []
            if not ids:
                first, last, n_bytes = at, at, 0
            ids.append(event_id)
            state = (number, first, max(last, at), n_bytes + int(size))
            if state[3] >= self.max_bytes:
                done.append(self._closed(feed, state, ids, FULL))
                state, ids = (number + 1, -1, -1, 0), []
        self._store(tuple(int(x) for x in state), ids)
        if done:
            yield pd.DataFrame(done)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state, ids = self._load()
        if ids:
            self._store((state[0] + 1, -1, -1, 0), [])
            yield pd.DataFrame([self._closed(key[0], state, ids, TIME)])


def batched(
    stream: DataFrame,
    feed: str | Column,
    event_id: str,
    ts: str,
    size: Column,
    max_bytes: int = BATCH_BYTES,
    window: timedelta = timedelta(minutes=5),
    lateness: str = "0 seconds",
) -> DataFrame:
    """The closed batches of each feed with the ids of their events, in append mode.

    Events are taken in the order of time and id within a micro-batch. One that
    comes after later ones still belongs to the batch that is then open; those
    later than ``lateness`` behind the newest are dropped by the watermark, and
    those without a time cannot be put anywhere and are left out. A feed is worked on by one task at a time: give a busy source several feeds.
    """
    spark = stream.sparkSession
    use_rocksdb(spark)
    ship_package(spark)
    events = stream.filter(F.col(ts).isNotNull()).withWatermark(ts, lateness).select(
        (F.col(feed) if isinstance(feed, str) else feed).cast("string").alias("feed"),
        F.col(event_id).cast("string").alias("event_id"),
        F.unix_micros(F.col(ts)).alias("at_us"),
        size.cast("bigint").alias("size"),
        F.col(ts).alias("at"),
    )
    micros = int(window / timedelta(microseconds=1))
    return events.groupBy("feed").transformWithStateInPandas(Batcher(max_bytes, micros), BATCHES, "append", "eventTime")
