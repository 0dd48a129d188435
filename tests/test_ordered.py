import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterline.operators.ordered import CHUNK, cut_in_order, previous_in_order, running_sum_before
from meterline.streaming.events import assign_batches


@pytest.fixture(scope="module")
def rows():
    """A third of the rows share one key; times repeat, the id tells rows apart."""
    rng = random.Random(7)
    keys = [1] * 400 + [rng.randrange(2, 150) for _ in range(790)] + [None] * 10
    return [(k, rng.randrange(60), i, rng.choice("abc"), rng.randrange(1, 9)) for i, k in enumerate(keys)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, t int, i int, s string, n int").repartition(5)


def test_chunks_cut_the_hot_key(frame):
    per_chunk = cut_in_order(frame, ["k"], ["t", "i"], chunks=8).groupBy(CHUNK).count().collect()
    assert len(per_chunk) == 8 and max(r["count"] for r in per_chunk) < 300


@pytest.mark.parametrize("chunks", [1, 8, 40])
def test_previous_row_equals_brute_force(frame, rows, chunks):
    got = {
        r.i: (r.before, r.n_before)
        for r in previous_in_order(frame, ["k"], ["t", "i"], {"before": "s", "n_before": "n"}, chunks).collect()
    }
    want, last = {}, {}
    for k, t, i, s, n in sorted(rows, key=lambda r: (r[0] or 0, r[1], r[2])):
        want[i] = last.get(k, (None, None))
        last[k] = (s, n)
    assert got == want


@pytest.mark.parametrize("chunks", [1, 8, 40])
def test_running_sum_equals_brute_force(frame, rows, chunks):
    got = {r.i: r.total for r in running_sum_before(frame, ["k"], ["t", "i"], "n", "total", chunks).collect()}
    want, totals = {}, {}
    for k, t, i, s, n in sorted(rows, key=lambda r: (r[0] or 0, r[1], r[2])):
        want[i] = totals.get(k, 0)
        totals[k] = want[i] + n
    assert got == want


def test_batches_close_by_size_or_window(spark):
    start = pd.Timestamp("2024-01-01")
    sizes = [100, 100, 100, 300, 10, 10]
    minutes = [0, 1, 2, 3, 6, 7]
    df = spark.createDataFrame(
        pd.DataFrame({"id": range(6), "ts": [start + pd.Timedelta(minutes=m) for m in minutes], "size": sizes})
    )
    batched = assign_batches(df, "ts", ["id"], F.col("size"), max_bytes=256).orderBy("id").collect()
    assert [r.batch_no for r in batched] == [0, 0, 0, 1, 0, 0]
    assert batched[3].batch_window != batched[4].batch_window


def test_chunks_follow_the_size_of_the_input(spark, tmp_path):
    from meterline.session import input_bytes, partitions_for

    path = f"{tmp_path}/t"
    spark.range(50_000).selectExpr("id", "uuid() AS text").write.parquet(path)
    df = spark.read.parquet(path)
    size = input_bytes(df)
    assert size > 1_000_000 and input_bytes(df.join(df, "id")) == 2 * size
    assert partitions_for(df, size // 40) >= 40 and partitions_for(df) == 4
    assert partitions_for(df, 1, most=77) == 77
    assert partitions_for(spark.createDataFrame([(1,)], "id int")) == 4


@pytest.mark.parametrize("hot", [False, True])
def test_only_large_keys_are_cut(spark, hot):
    n, key = 30_000, F.lit(1) if hot else F.col("id") % 10_000
    df = spark.range(n, numPartitions=3).select(key.alias("k"), F.col("id").alias("i"), F.expr("id % 7").alias("v"))
    got = previous_in_order(df, ["k"], ["i"], {"before": "v"})
    assert ("RepartitionByExpression" in got._jdf.queryExecution().optimizedPlan().toString() or CHUNK in got._jdf.queryExecution().optimizedPlan().toString()) == hot
    step = 1 if hot else 10_000
    assert got.filter(~F.col("before").eqNullSafe(F.when(F.col("i") >= step, (F.col("i") - step) % 7))).count() == 0 and got.count() == n


def test_what_is_ordered_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(100).selectExpr("id % 5 AS k", "id AS i", "id AS v").mapInArrow(count, "k long, i long, v long")
    assert previous_in_order(df, ["k"], ["i"], {"before": "v"}).filter("before IS NULL").count() == 5
    assert seen.value == 100
