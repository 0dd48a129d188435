"""Table maintenance: small files, touched partitions, compaction, retention.

Decisions are made on file tables (:func:`meterline.sources.files.file_table`),
one row per file, so they cost a listing and no data scan.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from meterline.operators.profile import observe_rows
from meterline.sources.files import exists, file_table, remove, restore, swap_in

# What counts as a small file, and how long raw files stay.
SMALL_FILE = 64 * 1024 * 1024
TIERING_MINIMUM = 128 * 1024
RETENTION_DAYS = 30
TARGET_FILE = 256 * 1024 * 1024

RESULTS = (
    "partition string, status string, files_before bigint, files_after bigint, "
    "row_count bigint, error string"
)


def small_files(files: DataFrame, by: Sequence[str], size: str = "length") -> DataFrame:
    """Per partition: files, bytes, and how many files are below the two limits."""
    return files.groupBy(*by).agg(
        F.count("*").alias("n_files"),
        F.sum(size).alias("n_bytes"),
        F.count_if(F.col(size) < SMALL_FILE).alias("n_small"),
        F.count_if(F.col(size) < TIERING_MINIMUM).alias("n_tiny"),
    )


def touched_partitions(
    files: DataFrame, by: Sequence[str], since: datetime | Column, changed: str = "modificationTime"
) -> DataFrame:
    """Partitions with a file changed after ``since``."""
    moment = since if isinstance(since, Column) else F.lit(since)
    return files.filter(F.col(changed) > moment).select(*by).distinct()


def compaction_gate(
    files: DataFrame,
    by: Sequence[str],
    *,
    min_files: int = 2,
    now: datetime | Column | None = None,
    max_age_hours: float | None = None,
    size: str = "length",
    changed: str = "modificationTime",
    small: int = SMALL_FILE,
) -> DataFrame:
    """Partitions worth compacting: enough small files, or small files that have
    waited too long (when ``max_age_hours`` is given)."""
    moment = F.current_timestamp() if now is None else now if isinstance(now, Column) else F.lit(now)
    waiting = files.filter(F.col(size) < small).groupBy(*by).agg(
        F.count("*").alias("n_small"), F.min(changed).alias("oldest")
    )
    due = F.col("n_small") >= min_files
    if max_age_hours is not None:
        age = F.unix_seconds(moment.cast("timestamp")) - F.unix_seconds(F.col("oldest").cast("timestamp"))
        due = due | ((F.col("n_small") > 1) & (age >= max_age_hours * 3600))
    return waiting.filter(due)


def expired_files(
    files: DataFrame,
    now: datetime | Column,
    days: int = RETENTION_DAYS,
    changed: str = "modificationTime",
) -> DataFrame:
    """Files older than the retention. They are listed; deleting is the storage policy's part."""
    moment = now if isinstance(now, Column) else F.lit(now)
    return files.filter(F.col(changed) < moment - F.expr(f"INTERVAL {int(days)} DAYS"))


def within_retention(df: DataFrame, ts: str, now: Column, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows of a table that are not expired."""
    return df.filter(F.col(ts) >= now - F.expr(f"INTERVAL {int(days)} DAYS"))


def _folder(partition: Row, by: Sequence[str]) -> str:
    """The folder of a partition, with values spelled the way Spark writes them."""

    def spell(value) -> str:
        if value is None:
            return "__HIVE_DEFAULT_PARTITION__"
        return re.sub(r"""["#%'*/:=?\\{\[\]^\x00-\x1f\x7f]""", lambda m: f"%{ord(m[0]):02X}", str(value))

    return "/".join(f"{column}={spell(partition[column])}" for column in by)


def compact_partition(
    spark: SparkSession, root: str, folder: str, target_bytes: int = TARGET_FILE, leaf: dict | None = None
) -> tuple[int, int, int]:
    """Rewrite one partition folder with files of about ``target_bytes``.

    The new files are written beside the table, their rows counted by the
    writing tasks and compared with the old ones, and only then swapped in by
    rename. The old files stay under ``_retired`` until the next compaction.
    ``leaf`` names sub-partitions (such as a batch id) that merge into one value.
    Returns (files before, files after, rows).
    """
    live, staged, retired = (f"{root}/{kind}{folder}" for kind in ("", "_staged/", "_retired/"))
    restore(spark, live, retired)
    stats = (
        file_listing(spark, live).agg(F.count("*").alias("n"), F.sum("length").alias("bytes")).first()
    )
    goal = max(1, math.ceil((stats["bytes"] or 0) / target_bytes))
    old = spark.read.parquet(live)
    expected = old.count()
    rows, seen = observe_rows(old.drop(*(leaf or {})))
    # Each task reads about target_bytes and writes one file: no shuffle.
    packed = rows.coalesce(goal)
    if leaf:
        packed = packed.withColumns({c: F.lit(v) for c, v in leaf.items()})
    writer = packed.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*leaf) if leaf else writer).parquet(staged)
    written = seen.get["row_count"]
    if written != expected:
        raise RuntimeError(f"{folder}: {written} rows written, {expected} expected")
    if exists(spark, retired):  # from an earlier compaction that is complete
        remove(spark, retired)
    swap_in(spark, staged, live, retired)
    after = file_listing(spark, live).count()
    return stats["n"], after, expected


def file_listing(spark: SparkSession, folder: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length")
    )


def compact(
    spark: SparkSession,
    root: str,
    partitions: DataFrame,
    by: Sequence[str],
    target_bytes: int = TARGET_FILE,
    workers: int = 8,
    leaf: dict | None = None,
) -> DataFrame:
    """Compact the listed partitions, several at a time, each on its own.

    One failing partition does not stop the others. The result has a row per
    partition with its status. The driver holds partition names only.
    """
    folders = [_folder(row, by) for row in partitions.select(*by).distinct().collect()]

    def attempt(folder: str) -> tuple:
        try:
            before, after, rows = compact_partition(spark, root, folder, target_bytes, leaf)
        except Exception as exc:
            return folder, "failed", None, None, None, f"{type(exc).__name__}: {exc}"
        return folder, "compacted", before, after, rows, None

    with ThreadPoolExecutor(max_workers=workers) as pool:
        outcomes = list(pool.map(attempt, sorted(folders)))
    return spark.createDataFrame(outcomes, RESULTS)


def compact_touched(
    spark: SparkSession, root: str, by: Sequence[str], since: datetime, **options
) -> DataFrame:
    """Compact what changed after ``since`` and passes the gate."""
    gate = {k: options.pop(k) for k in ("min_files", "max_age_hours", "now") if k in options}
    files = file_table(spark, root)
    due = compaction_gate(files, by, **gate).select(*by)
    touched = touched_partitions(files, by, since)
    return compact(spark, root, touched.join(due, list(by), "left_semi"), by, **options)
