"""Stateful batching against a plain replay, over micro-batches and a restart."""

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from meterline.streaming.batches import BATCHES, batched

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "feed string, id long, ts timestamp, size int"


def replay(events, max_bytes, window):
    """Closed batches, as (feed, number, closed by, ids): by size, or by time once the newest event of all is past their end."""
    newest, out = max(ts for *_, ts, _ in events), []
    for feed in sorted({e[0] for e in events}):
        number, opened, ids, total = 0, None, [], 0
        for _, i, ts, size in sorted((e for e in events if e[0] == feed), key=lambda e: (e[2], str(e[1]))):
            if ids and ts >= opened + window:
                out.append((feed, number, "time", ids))
                number, ids = number + 1, []
            if not ids:
                opened, total = ts, 0
            ids, total = [*ids, str(i)], total + size
            if total >= max_bytes:
                out.append((feed, number, "size", ids))
                number, ids = number + 1, []
        if ids and opened + window <= newest:
            out.append((feed, number, "time", ids))
    return sorted(out)


def test_equals_a_replay_over_micro_batches_and_a_restart(spark, tmp_path):
    rng = random.Random(5)
    moments = sorted(rng.sample(range(0, 7200), 260))
    events = [(rng.choice("aab"), n, START + timedelta(seconds=s), rng.choice([1, 10, 40])) for n, s in enumerate(moments)]
    events.append(("c", 900, START + timedelta(seconds=10), 5))  # no further event closes its batch, a timer does
    events.sort(key=lambda e: e[2])
    parts = [events[k : k + 45] for k in range(0, len(events), 45)]
    for n, part in enumerate(parts):
        spark.createDataFrame([*part, ("a", 10_000 + n, None, 1)], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        if n % 2 or n == len(parts) - 1:  # each run is a new query over the same checkpoint
            stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
            closed = batched(stream, "feed", "id", "ts", F.col("size"), max_bytes=100, window=timedelta(minutes=5))
            writer = closed.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/check")
            writer.trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(BATCHES).parquet(f"{tmp_path}/out").collect()
    assert sorted((r.feed, r.batch_no, r.closed_by, r.event_ids) for r in rows) == replay(events, 100, timedelta(minutes=5))
    assert all(r.n_bytes >= 100 if r.closed_by == "size" else r.last_at - r.opened_at < timedelta(minutes=5) for r in rows)
    assert {r.closed_by for r in rows} == {"size", "time"} and ("c", 0) in {(r.feed, r.batch_no) for r in rows}
