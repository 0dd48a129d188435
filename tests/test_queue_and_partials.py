"""The queue of file events, and gold tables refreshed by partition."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from meterline.plans.file_queue import FileQueue, compact_due
from meterline.plans.partial_gold import PartialGold
from meterline.sources.files import remove
from meterline.sources.sinks import write_partitioned

NOW = datetime(2024, 3, 1, 12, tzinfo=timezone.utc)
FILES = "day string, kind string, length bigint, modificationTime timestamp"


def files(spark, *rows):
    return spark.createDataFrame([(d, k, 10, NOW - timedelta(hours=age)) for d, k, age in rows], FILES)


def prefixes(df):
    return sorted((r.day, str(r.kind), r.n_files) for r in df.collect())


@pytest.fixture
def queue(spark, tmp_path):
    queue = FileQueue(spark, f"{tmp_path}/queue", ["day", "kind"])
    queue.arrive("1", files(spark, ("a", "x", 1), ("a", "x", 2), ("a", None, 3), ("b", "y", 30)))
    return queue


def test_each_prefix_is_taken_once(spark, queue):
    queue.arrive("1", files(spark, ("a", "x", 1), ("a", "x", 2), ("a", None, 3), ("b", "y", 30)))  # announced again
    queue.arrive("2", files(spark, ("a", "x", 0)))
    for _ in range(2):  # the same run, started again
        assert prefixes(queue.drain("r1", NOW)) == [("a", "None", 1), ("a", "x", 3), ("b", "y", 1)]
    assert queue.drain("r2", NOW).count() == 0
    queue.arrive("3", files(spark, ("a", "x", 0)))
    assert [r.n_files for r in queue.drain("r3", NOW).collect()] == [1]  # only the new file


def test_a_crash_loses_and_repeats_nothing(spark, queue):
    queue.drain("dies", NOW)
    assert queue.drain("early", NOW + timedelta(hours=1)).count() == 0
    later = NOW + timedelta(hours=7)
    assert queue.drain("next", later).count() == 3
    queue.acknowledge("next", queue._leased("next"))
    queue.acknowledge("dies", queue._leased("dies"))  # wakes up late
    assert queue.waiting(later + timedelta(days=9)).count() == 0
    queue.tidy()
    assert queue.waiting(later + timedelta(days=9)).count() == 0 and len(queue.table.version().segments) == 1
    queue.arrive("4", files(spark, ("b", "y", 0)))
    assert prefixes(queue.waiting(later)) == [("b", "y", 1)]


def test_what_failed_comes_back(spark, queue):
    due = queue.drain("r1", NOW)
    queue.acknowledge("r1", due.filter("kind = 'x'"))
    assert {(r.day, r.kind) for r in queue.waiting(NOW).collect()} == {("a", None), ("b", "y")}
    queue.drain("r2", NOW)
    queue.release("r2")
    assert queue.waiting(NOW).count() == 2


def test_the_gate_reads_age_and_count(spark, queue):
    assert prefixes(queue.drain("r1", NOW, min_files=2)) == [("a", "x", 2)]
    assert prefixes(queue.drain("r2", NOW, min_files=9, max_age=timedelta(hours=24))) == [("b", "y", 1)]


def test_another_run_between_reading_and_leasing(spark, queue):
    other = FileQueue(spark, queue.table.root, queue.by)
    whole, raced = queue.table.write, []

    def write(name, rows, side):
        segment = whole(name, rows, side)
        if not raced:
            raced.append(1)
            other.drain("faster", NOW)
        return segment

    queue.table.write = write
    assert queue.drain("slower", NOW).count() == 0 and other.drain("faster", NOW).count() == 3


def test_compaction_from_the_queue(spark, tmp_path):
    root = f"{tmp_path}/lake"
    rows = spark.range(40).selectExpr("id", "concat('d', id % 3) AS day", "'x' AS kind")
    for part in (0, 1):
        rows.filter(f"id % 2 = {part}").repartition(2).write.partitionBy("day", "kind").mode("append").parquet(root)
    queue = FileQueue(spark, f"{tmp_path}/queue", ["day", "kind"])
    queue.arrive("1", files(spark, ("d0", "x", 1), ("d1", "x", 1), ("gone", "x", 1)))
    report = {r.partition: r.status for r in compact_due(queue, root, "r1", NOW).collect()}
    assert report == {"day=d0/kind=x": "compacted", "day=d1/kind=x": "compacted", "day=gone/kind=x": "failed"}
    assert prefixes(queue.waiting(NOW)) == [("gone", "x", 1)] and spark.read.parquet(root).count() == 40


def sales(spark):
    return spark.range(400).selectExpr("id", "cast(id % 4 as int) AS year", "cast(id % 3 as int) AS month", "concat('g', id % 5) AS g", "CASE WHEN id % 7 > 0 THEN id / 100.0 END AS amount")


@pytest.mark.parametrize("cents", [True, False])
def test_partial_gold_equals_a_full_build(spark, tmp_path, cents):
    path = f"{tmp_path}/sales"
    write_partitioned(sales(spark).filter("id % 2 = 0"), path)
    gold = PartialGold(spark, f"{tmp_path}/gold", {"g": F.col("g")}, "amount", where=F.col("id") > 10, cents=cents)
    with pytest.raises(ValueError, match="whole first"):
        gold.refresh(spark.read.parquet(path), spark.createDataFrame([(0, 1)], "year int, month int"))
    gold.refresh(spark.read.parquet(path))
    write_partitioned(sales(spark).filter("id % 2 = 1 AND year = 1"), path, replace="none")  # late files
    write_partitioned(sales(spark).filter("id % 10 = 0 AND year = 0 AND month = 1"), path, replace="touched")  # a replaced partition
    remove(spark, f"{path}/year=2/month=2")  # an emptied one
    touched = spark.createDataFrame([(1, 0), (1, 1), (1, 2), (0, 1), (2, 2)], "year int, month int")
    now = spark.read.parquet(path)
    gold.refresh(now, touched)
    full = PartialGold(spark, f"{tmp_path}/full", {"g": F.col("g")}, "amount", where=F.col("id") > 10, cents=cents)
    full.refresh(now)
    rounded = lambda t: sorted((r.g, round(r.avg_amount, 9), r.n_rows) for r in t.collect())
    assert rounded(gold.table()) == rounded(full.table()) and gold.table().count() == 5
