"""Previous rows and running sums without one task per key.

A window partitioned by key sorts each key in one task, which fails when one
key holds a third of the rows. Here the rows are range-partitioned on key *and*
order into chunks of similar size, so a hot key is cut into many chunks. Only
what crosses a chunk border is carried over, at most a few rows per chunk.

The chunked rows are written to the shared scratch folder once: both passes
then see the same chunks, also after a lost executor.

Where no key is large there is nothing to cut: rows are counted by hashes of
their keys first, and if no hash has too many, a window per key does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.session import only_scans, partitions_for, scratch_path

CHUNK = "_chunk"
#: Keys are counted by so many hashes a partition, and keys of so few rows are never cut.
HASHES, FEW_ROWS = 16, 10_000


def kept(df: DataFrame, label: str) -> DataFrame:
    """A frame that is read more than once: written to scratch unless it is a scan already."""
    if only_scans(df):
        return df
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def has_large_keys(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether some key may have more than half of a partition's even share of the rows.

    A key has at most as many rows as its hash; what is counted is a row per hash and task.
    """
    n = partitions_for(df)
    counts = df.groupBy(F.pmod(F.xxhash64(*keys), F.lit(HASHES * max(n, 256))).alias("hash")).count()
    seen = counts.agg(F.sum("count").alias("rows"), F.max("count").alias("most")).first()
    return (seen["most"] or 0) > max(FEW_ROWS, (seen["rows"] or 0) / n / 2)


def cut_in_order(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunks: int | None = None
) -> DataFrame:
    """The rows with a chunk number; chunks follow each other in (keys, order). There are as many as the input's size asks for.

    ``keys`` and ``order`` together should tell any two rows apart. All columns
    given are written to scratch, so pass a narrow frame.
    """
    spark = df.sparkSession
    n = chunks or partitions_for(df)
    ranged = df.repartitionByRange(n, *keys, *order).withColumn(CHUNK, F.spark_partition_id())
    path = scratch_path(spark, "ordered")
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def previous_in_order(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: dict[str, str],
    chunks: int | None = None,
) -> DataFrame:
    """For each new name in ``values``, the named column in the key's previous row.

    Large keys are cut into chunks, and all keys are if ``chunks`` says how many.
    """
    if chunks is None:
        df = kept(df, "to-order")
        if not has_large_keys(df, keys):
            along = Window.partitionBy(*keys).orderBy(*order)
            return df.withColumns({new: F.lag(source).over(along) for new, source in values.items()})
    cut = cut_in_order(df, keys, order, chunks)
    row = F.struct(
        F.struct(*keys).alias("key"), *(F.col(source).alias(new) for new, source in values.items())
    )
    inside = Window.partitionBy(CHUNK).orderBy(*keys, *order)
    last_rows = cut.groupBy(CHUNK).agg(F.max_by(row, F.struct(*keys, *order)).alias("_last"))
    # One row per chunk: small enough for one task and for a broadcast.
    carried = last_rows.select(
        CHUNK, F.lag("_last").over(Window.orderBy(CHUNK)).alias("_carried")
    )
    seen = cut.withColumn("_previous", F.lag(row).over(inside)).join(
        F.broadcast(carried), CHUNK, "left"
    )
    previous = F.coalesce(F.col("_previous"), F.col("_carried"))
    same_key = previous["key"].eqNullSafe(F.struct(*keys))
    return seen.withColumns({new: F.when(same_key, previous[new]) for new in values}).drop(
        CHUNK, "_previous", "_carried"
    )


def running_sum_before(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    amount: str,
    name: str,
    chunks: int | None = None,
) -> DataFrame:
    """Sum of ``amount`` over the key's earlier rows (0 for its first row)."""
    cut = cut_in_order(df, keys, order, chunks)
    key = F.struct(*keys)
    borders = cut.groupBy(CHUNK).agg(F.min(key).alias("first_key"), F.max(key).alias("last_key"))
    # A key in two chunks ends one and starts the next: at most two such keys per chunk.
    crossing = borders.select(
        F.explode(F.array_distinct(F.array("first_key", "last_key"))).alias("_border_key")
    ).distinct()
    totals = (
        cut.withColumn("_key", key)
        .join(F.broadcast(crossing), F.col("_key").eqNullSafe(F.col("_border_key")), "left_semi")
        .groupBy("_key", CHUNK)
        .agg(F.sum(amount).alias("_total"))
    )
    earlier = Window.partitionBy("_key").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("_key", F.col(CHUNK).alias("_at"), F.sum("_total").over(earlier).alias("_carried"))
    inside = (
        Window.partitionBy(CHUNK, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    zero = F.lit(0)
    return (
        cut.withColumns({"_inside": F.sum(amount).over(inside), "_own_key": key})
        .join(
            F.broadcast(carried),
            (F.col(CHUNK) == F.col("_at")) & F.col("_own_key").eqNullSafe(F.col("_key")),
            "left",
        )
        .withColumn(name, F.coalesce("_inside", zero) + F.coalesce("_carried", zero))
        .drop(CHUNK, "_inside", "_own_key", "_key", "_at", "_carried")
    )
