"""What the operators of this subpackage share: reading, counting, checks of size."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.session import scratch_path, ship_package, shuffle_partitions

T = TypeVar("T")

#: Text is cut into words at ASCII white space only.
SPACES = r"[\x20\x09-\x0D]+"


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone, a null text being empty; further columns are left behind."""
    ship_package(docs.sparkSession)
    return docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """The part of the corpus that a document belongs to: crc32 of the id as text."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again, which cuts the lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: So many bytes of rows go to a Python worker at a time; a batch lies in the JVM and in the worker at once.
BATCH_BYTES, BATCH_CONF = 3 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def limit_batches(spark: SparkSession) -> str:
    """From now on the session sends rows to Python in batches of ``BATCH_BYTES``, or of less if it said so; returns what it said.

    Only how many rows go at a time changes; a row that is larger is a batch of its own.
    """
    before = spark.conf.get(BATCH_CONF)
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    spark.conf.set(BATCH_CONF, str(min(most, BATCH_BYTES)))
    return before


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """:func:`limit_batches` for the jobs that run meanwhile."""
    before = limit_batches(spark)
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, before)


_kept: dict[object, object] = {}


def kept_by_worker(key: object, make: Callable[[], T]) -> T:
    """What an operator keeps in a Python worker from task to task, so that the words it knows serve all of them.

    Workers outlive the operators of a job, so only the latest one's is kept: another's is let go first.
    """
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


#: Spark's estimate for frames whose size it does not know is far above this.
KNOWN_SIZE = 1 << 60


def block_count(df: DataFrame, bytes_a_block: int) -> int:
    """How many blocks of about this size the input makes, by the plan's own estimate of its size.

    Where Spark cannot tell, there are as many as its shuffles have partitions.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    size = int(str(plan.stats().sizeInBytes()))
    if size >= KNOWN_SIZE:
        return shuffle_partitions(df.sparkSession)
    return max(1, min(1_000_000, -(-size // bytes_a_block)))
