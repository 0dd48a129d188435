from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from meterline.plans.maintenance import (
    compact,
    compact_touched,
    compaction_gate,
    expired_files,
    small_files,
    touched_partitions,
    within_retention,
)
from meterline.sources.files import file_table

LONG_AGO = datetime(2000, 1, 1, tzinfo=timezone.utc)


@pytest.fixture
def table(spark, tmp_path):
    """Two days, three small files each, and a batch id below the day."""
    root = str(tmp_path / "t")
    for batch in range(3):
        spark.range(10).select("id", (F.col("id") % 2 + 1).alias("day"), F.lit(batch).alias("batch_id")).coalesce(
            1
        ).write.partitionBy("day", "batch_id").mode("append").parquet(root)
    return root


def test_file_reports(spark, table):
    files = file_table(spark, table)
    report = {r.day: (r.n_files, r.n_small, r.n_tiny) for r in small_files(files, ["day"]).collect()}
    assert report == {1: (3, 3, 3), 2: (3, 3, 3)}
    assert touched_partitions(files, ["day"], LONG_AGO).count() == 2
    assert touched_partitions(files, ["day"], datetime.now(timezone.utc) + timedelta(days=1)).count() == 0
    assert expired_files(files, datetime.now(timezone.utc)).count() == 0
    assert expired_files(files, datetime.now(timezone.utc) + timedelta(days=31)).count() == 6


def test_gate(spark, table):
    files = file_table(spark, table)
    later = datetime.now(timezone.utc) + timedelta(hours=30)
    assert compaction_gate(files, ["day"], min_files=3).count() == 2
    assert compaction_gate(files, ["day"], min_files=4).count() == 0
    assert compaction_gate(files, ["day"], min_files=4, now=later, max_age_hours=24).count() == 2
    assert compaction_gate(files, ["day"], min_files=4, now=later, max_age_hours=48).count() == 0
    assert compaction_gate(files, ["day"], min_files=1, small=1).count() == 0


def test_compaction_keeps_the_rows(spark, table):
    before = spark.read.parquet(table).select("id", "day")
    before_rows = sorted(tuple(r) for r in before.collect())
    report = compact(spark, table, file_table(spark, table), ["day"], leaf={"batch_id": -1})
    assert {(r.partition, r.status, r.files_before, r.files_after, r.row_count) for r in report.collect()} == {
        ("day=1", "compacted", 3, 1, 15), ("day=2", "compacted", 3, 1, 15),
    }
    after = spark.read.parquet(table)
    assert sorted((r.id, r.day) for r in after.collect()) == before_rows
    assert [r.batch_id for r in after.select("batch_id").distinct().collect()] == [-1]
    again = compact(spark, table, file_table(spark, table), ["day"], leaf={"batch_id": -1})
    assert [r.status for r in again.collect()] == ["compacted"] * 2
    assert spark.read.parquet(table).count() == 30


def test_target_size_sets_the_number_of_files(spark, tmp_path):
    root = str(tmp_path / "t")
    spark.range(8000).select(F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(1).alias("day")).repartition(
        12
    ).write.partitionBy("day").parquet(root)
    total = file_table(spark, root).agg(F.sum("length")).first()[0]
    report = compact(spark, root, file_table(spark, root), ["day"], target_bytes=total // 4 + 1).first()
    assert (report.files_before, report.files_after) == (12, 4)


def test_one_failing_partition_does_not_stop_the_others(spark, table, tmp_path):
    (tmp_path / "t" / "day=1" / "batch_id=0" / "part-broken.parquet").write_text("not parquet")
    report = {r.partition: r for r in compact(spark, table, file_table(spark, table), ["day"]).collect()}
    assert report["day=1"].status == "failed" and report["day=1"].error
    assert report["day=2"].status == "compacted"
    assert (tmp_path / "t" / "day=1" / "batch_id=2").exists()  # left as it was


def test_compact_touched(spark, table):
    assert compact_touched(spark, table, ["day"], datetime.now(timezone.utc) + timedelta(days=1)).count() == 0
    report = compact_touched(spark, table, ["day"], LONG_AGO, min_files=2, leaf={"batch_id": -1})
    assert report.filter("status = 'compacted'").count() == 2
    assert compact_touched(spark, table, ["day"], LONG_AGO, min_files=2, leaf={"batch_id": -1}).count() == 0


def test_retention_of_rows(spark):
    df = spark.sql("SELECT timestamp'2024-01-01' ts UNION ALL SELECT timestamp'2024-02-10'")
    now = F.lit("2024-02-15").cast("timestamp")
    assert within_retention(df, "ts", now).count() == 1


def test_odd_partition_values(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a:b"), (2, None), (3, "c/d 50%"), (4, "plain")], "id int, place string")
    df.write.partitionBy("place").parquet(root)
    report = compact(spark, root, file_table(spark, root), ["place"])
    assert [r.status for r in report.collect()] == ["compacted"] * 4
    after = {(r.id, r.place) for r in spark.read.parquet(root).collect()}
    assert after == {(1, "a:b"), (2, None), (3, "c/d 50%"), (4, "plain")}
