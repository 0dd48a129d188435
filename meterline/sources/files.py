"""File listings as tables, and the few file-system calls publishing needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# The taxi kinds that paths name.
KINDS = ("green", "yellow")


def file_table(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per data file: path, modification time, bytes, and the partition
    columns of the folders above it. File contents are not read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(root).drop("content")
    )


def discover(spark: SparkSession, pattern: str) -> tuple[list[str], int]:
    """Sorted paths matching a glob, and their bytes. Sorting fixes the column
    order of later unions."""
    found = spark.read.format("binaryFile").load(pattern).select("path", "length").collect()
    return sorted(row["path"] for row in found), sum(row["length"] for row in found)


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    return discover(spark, pattern)[0]


def file_attributes(files: DataFrame, path: str = "path") -> DataFrame:
    """Taxi kind, year and month from paths like ``yellow_tripdata_2023-01.parquet``:
    the kind that the path, folders included, names first, and the period that
    stands right before ``.parquet``. Files without either are left out."""
    ending = ".parquet"
    whole = F.col(path)
    stem = F.left(whole, F.length(whole) - len(ending))
    period = F.right(stem, F.lit(len("2023-01")))
    places = F.array(*(F.struct(F.locate(kind, stem).alias("at"), F.lit(kind).alias("kind")) for kind in KINDS))
    attributes = {
        "taxi": F.array_min(F.filter(places, lambda x: x["at"] > 0))["kind"],
        "year": F.left(period, F.lit(4)).try_cast("int"),
        "month": F.right(period, F.lit(2)).try_cast("int"),
    }
    named = files.filter(whole.endswith(ending) & period.rlike("^[0-9]{4}-[0-9]{2}$")).withColumns(attributes)
    return named.filter(F.col("taxi").isNotNull() & F.col("year").between(1000, 9999) & F.col("month").between(1, 12))


def _file_system(spark: SparkSession, path: str):
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def exists(spark: SparkSession, path: str) -> bool:
    fs, handle = _file_system(spark, path)
    return fs.exists(handle)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, handle = _file_system(spark, path)
    return fs.exists(handle) and fs.getFileStatus(handle).isDirectory()


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, handle = _file_system(spark, source)
    goal = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(goal.getParent())
    if not fs.rename(handle, goal):
        raise OSError(f"could not move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, handle = _file_system(spark, path)
    fs.delete(handle, True)


def swap_in(spark: SparkSession, staged: str, live: str, retired: str) -> None:
    """Put ``staged`` where ``live`` is; the old files wait under ``retired``.

    Two renames, so a reader can meet a moment without the folder, and a crash
    between them is undone by :func:`restore`. No data is copied or deleted.
    """
    if exists(spark, live):
        move(spark, live, retired)
    move(spark, staged, live)


def restore(spark: SparkSession, live: str, retired: str) -> bool:
    """Finish or undo an interrupted swap: bring the old folder back if no new one is there."""
    if exists(spark, retired) and not exists(spark, live):
        move(spark, retired, live)
        return True
    return False
