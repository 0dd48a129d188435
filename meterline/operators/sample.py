"""Stratified samples and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], k: int = 1
) -> DataFrame:
    """The first ``k`` rows of each group in a total order; a NULL key is a group.

    Spark places a group limit below the exchange for this filter, so each map
    task sends at most ``k`` rows per group, whatever the size of the group.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") <= k).drop("_rank")


def preview(df: DataFrame, order: Sequence[str | Column], n: int = 5) -> DataFrame:
    """The first rows in order: a top-n per task, then a top-n of those."""
    return df.orderBy(*order).limit(n)
