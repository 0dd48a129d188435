"""Partitioned parquet, CSV and gold tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from meterline.operators.validate import Contract, WriteCheck
from meterline.sources.files import remove, restore, swap_in

#: A writing task keeps the files of so many partitions open; only rows of further ones are sorted.
OPEN_FILES, OPEN_FILES_CONF = 64, "spark.sql.maxConcurrentOutputFileWriters"
#: Shuffle files go when the query that made them ends, not when the driver happens to collect its garbage.
FREE_FILES_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def open_files(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes that run meanwhile do not sort their rows, for rows that :func:`spread` brought together.

    A task then has rows of few partitions, and what it holds is their encoded
    columns; a sort would hold, and spill, the rows as wide as they have become.
    What such a write has shuffled is removed at its end, so that the next one finds the disk free.
    """
    before, free = spark.conf.get(OPEN_FILES_CONF), spark.conf.get(FREE_FILES_CONF, "false")
    spark.conf.set(OPEN_FILES_CONF, str(max(int(before), OPEN_FILES)))
    spark.conf.set(FREE_FILES_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(OPEN_FILES_CONF, before)
        spark.conf.set(FREE_FILES_CONF, free)


def spread(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together for the write.

    Rebalancing groups by the partition columns like a repartition, but AQE
    splits a partition that holds too much and joins the tiny ones, so a month
    with a third of all trips is written by many tasks.
    """
    return df.hint("rebalance", *by)


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str] = ("year", "month"), replace: str = "all"
) -> None:
    """``replace``: "all" the table, only the "touched" partitions, or "none" (append)."""
    writer = spread(df, by).write.partitionBy(*by)
    if replace == "none":
        writer.mode("append").parquet(path)
    else:
        mode = {"all": "static", "touched": "dynamic"}[replace]
        writer.mode("overwrite").option("partitionOverwriteMode", mode).parquet(path)


def write_checked(
    df: DataFrame, path: str, contract: Contract, by: Sequence[str] = ("year", "month")
) -> int:
    """Write beside the table, check the contract in the same pass, then swap in.

    The checks sit after the rebalance, in the tasks that write, and a failing
    table is never published. Returns the number of rows.
    """
    spark = df.sparkSession
    live = path.rstrip("/")
    staged, retired = f"{live}__staged", f"{live}__retired"
    restore(spark, live, retired)
    check = WriteCheck(spread(df, by), contract)
    check.frame.write.partitionBy(*by).mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).parquet(staged)
    check.raise_if_failed()
    swap_in(spark, staged, live, retired)
    remove(spark, retired)
    return check.row_count


def write_csv(df: DataFrame, path: str, sep: str = ";") -> None:
    df.write.mode("overwrite").option("sep", sep).option("header", True).csv(path)


def write_gold(spark: SparkSession, sql: str, path: str) -> DataFrame:
    """Run a SQL model, store its result, and return the stored table."""
    spark.sql(sql).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
