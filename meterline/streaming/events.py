"""Event streams: duplicates and batching."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.operators.ordered import running_sum_before
from meterline.sources.files import exists
from meterline.sources.sinks import write_partitioned

# Bounds of an ingestion batch, and how long a queue keeps events.
BATCH_BYTES = 256 * 1024
BATCH_WINDOW = "5 minutes"
QUEUE_RETENTION = "14 days"


def drop_redeliveries(
    stream: DataFrame, ids: Sequence[str], ts: str, within: str = QUEUE_RETENTION
) -> DataFrame:
    """Drop events delivered again. Ids are remembered for as long as the queue
    could still repeat them, so the state does not grow without bound.

    Events that come later than that behind the newest are dropped too, seen or
    not: for feeds that can be filled up afterwards use :class:`EventStore`."""
    return stream.withWatermark(ts, within).dropDuplicatesWithinWatermark(list(ids))


class EventStore:
    """Keeps every event once, however late or often it is delivered; for ``foreachBatch``.

    Copies of an event carry its time, so a batch is compared with the stored
    days that its events lie in, and nothing has to be remembered or given up. A
    repeated batch replaces what it wrote.

    Where a part of its id is missing, an event is known by all its columns instead,
    so that no two different ones are taken for one. Events without a time share a
    day of their own.
    """

    def __init__(self, path: str, ids: Sequence[str], ts: str):
        self.path, self.ids, self.ts = path, list(ids), ts

    def _key(self, columns: Sequence[str]) -> Column:
        whole = F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)
        unknown = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in self.ids))
        return F.struct(*self.ids, F.when(unknown, whole).alias("whole"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
        key = self._key(batch.columns)
        fresh = batch.withColumns({"day": F.to_date(self.ts), "_key": key}).dropDuplicates(["_key"])
        if exists(spark, self.path):
            own = (F.col("stream_id") == stream) & (F.col("batch_id") == batch_id)
            days = fresh.select(F.col("day").alias("_day")).distinct()
            stored = spark.read.parquet(self.path).filter(~own)
            known = stored.join(days, F.col("day").eqNullSafe(F.col("_day")), "left_semi").select(key.alias("_known"))
            fresh = fresh.join(known, F.col("_key").eqNullSafe(F.col("_known")), "left_anti")
        place = {"stream_id": F.lit(stream), "batch_id": F.lit(batch_id).cast("bigint")}
        write_partitioned(fresh.drop("_key").withColumns(place), self.path, ("day", "stream_id", "batch_id"), replace="touched")


def assign_batches(
    events: DataFrame,
    ts: str,
    order: Sequence[str],
    size: Column,
    window: str = BATCH_WINDOW,
    max_bytes: int = BATCH_BYTES,
    chunks: int | None = None,
) -> DataFrame:
    """Adds ``batch_window`` and ``batch_no``: a batch closes when its window ends
    or when it has taken in ``max_bytes``, whichever is first.

    Windows are fixed and do not restart when a batch closes. Sizes are summed
    across chunks of the order, so a busy window does not end up in one task.
    """
    sized = events.withColumns({"batch_window": F.window(ts, window)["start"], "_bytes": size.cast("bigint")})
    summed = running_sum_before(sized, ["batch_window"], [ts, *order], "_bytes", "_before", chunks)
    number = F.floor(F.col("_before") / F.lit(max_bytes)).cast("bigint")
    return summed.withColumn("batch_no", number).drop("_bytes", "_before")


def touched_days(events: DataFrame, ts: str, since: Column) -> DataFrame:
    """Days with events later than ``since``."""
    return events.filter(F.col(ts) > since).select(F.to_date(ts).alias("day")).distinct()
