"""Gold tables kept up to date from the partitions that changed.

Sums and counts are stored per group and partition of the source. A refresh
computes those of the touched partitions alone and replaces them; the averages
are then made from all stored ones, a row per group and partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators.joins import fits_broadcast
from meterline.sources.files import exists
from meterline.sources.sinks import write_partitioned

EXACT = "decimal(28,2)"


class PartialGold:
    """``groups`` names the group columns, ``value`` is averaged, ``where`` says which rows count.

    With ``cents`` values are summed as exact decimals, so the result is that of a full build to the last digit.
    """

    def __init__(
        self, spark: SparkSession, path: str, groups: Mapping[str, Column], value: str, by: Sequence[str] = ("year", "month"), where: Column | None = None, cents: bool = True
    ):
        self.spark, self.path, self.groups, self.value, self.by = spark, path, dict(groups), value, list(by)
        self.where, self.cents = where, cents

    def _partials(self, rows: DataFrame) -> DataFrame:
        kept = rows if self.where is None else rows.filter(self.where)
        amount = F.col(self.value).cast("decimal(18,2)") if self.cents else F.col(self.value).cast("double")
        grouped = kept.groupBy(*self.by, *(c.alias(n) for n, c in self.groups.items()))
        total = F.sum(amount).cast(EXACT if self.cents else "double")
        return grouped.agg(total.alias("total"), F.count(self.value).alias("n"), F.count("*").alias("n_rows"))

    def refresh(self, source: DataFrame, touched: DataFrame | None = None) -> None:
        """Replace the partials of the touched partitions of ``source``; of all if none are given.

        A touched partition that has no rows any more is left with none.
        """
        if touched is None:
            write_partitioned(self._partials(source), self.path, self.by)
            return
        if not exists(self.spark, self.path):
            raise ValueError(f"{self.path} holds nothing yet: refresh it whole first")
        parts = touched.select(*self.by).distinct()
        side = F.broadcast(parts) if fits_broadcast(parts) else parts
        same = [source[c].eqNullSafe(parts[c]) for c in self.by]
        fresh = self._partials(source.join(side, same, "left_semi"))
        # A marker in each touched partition: an emptied one is replaced too.
        marked = fresh.unionByName(parts, allowMissingColumns=True).withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
        write_partitioned(marked, self.path, self.by, replace="touched")

    def table(self) -> DataFrame:
        """The averages of all groups."""
        partials = self.spark.read.parquet(self.path).filter("n_rows > 0")
        total = F.sum("total").cast("double")
        merged = partials.groupBy(*self.groups).agg(total.alias("total"), F.sum("n").alias("n"), F.sum("n_rows").alias("n_rows"))
        return merged.select(*self.groups, F.try_divide("total", F.col("n")).alias(f"avg_{self.value}"), "n_rows")
