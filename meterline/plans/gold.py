"""Gold tables: the two business questions, as DataFrames and as SQL models."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.sources.sinks import write_gold


def mean(column: str, cents: bool = False) -> Column:
    """Average. With ``cents`` amounts are summed as exact decimals, so the result
    does not depend on the order in which tasks finish."""
    if not cents:
        return F.avg(column)
    exact = F.sum(F.col(column).cast("decimal(18,2)"))
    return F.try_divide(exact.cast("double"), F.count(column))


def in_period(df: DataFrame, ts: str, year: int, first_month: int, last_month: int) -> DataFrame:
    """Rows of some months of a year, by bounds that reach the scan. Where the table is partitioned by year and
    month the filter also names those columns, which prunes folders."""
    start, end = date(year, first_month, 1), date(year + last_month // 12, last_month % 12 + 1, 1)
    kept = df.filter((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)))
    if {"year", "month"} <= set(df.columns):
        kept = kept.filter((F.col("year") == year) & F.col("month").between(first_month, last_month))
    return kept


def average_by_month(
    trips: DataFrame,
    year: int = 2023,
    months: tuple[int, int] = (1, 5),
    origin_id: int | None = 1,
    ts: str = "pickup_datetime",
    amount: str = "total_amount",
    cents: bool = False,
) -> DataFrame:
    """Question 1: average amount per pickup month."""
    kept = in_period(trips, ts, year, *months).filter(F.col(amount) >= 0)
    if origin_id is not None:
        kept = kept.filter(F.col("origin_id") == origin_id)
    return (
        kept.groupBy(F.month(ts).alias("month"))
        .agg(mean(amount, cents).alias(f"avg_{amount}"))
        .orderBy("month")
    )


def average_by_hour(
    trips: DataFrame,
    year: int = 2023,
    month: int = 5,
    ts: str = "pickup_datetime",
    amount: str = "total_amount",
    value: str = "passenger_count",
    cents: bool = False,
) -> DataFrame:
    """Question 2: average value per pickup hour, all taxi kinds."""
    kept = in_period(trips, ts, year, month, month).filter(F.col(amount) >= 0)
    return (
        kept.groupBy(F.hour(ts).alias("hour")).agg(mean(value, cents).alias(f"avg_{value}")).orderBy("hour")
    )


MODELS = {
    "avg_fare_by_month": """
        SELECT month(pickup_datetime) AS month, avg(total_amount) AS avg_total_amount
        FROM silver
        WHERE origin_id = 1 AND year = 2023 AND month BETWEEN 1 AND 5
          AND year(pickup_datetime) = 2023 AND month(pickup_datetime) BETWEEN 1 AND 5
          AND total_amount >= 0
        GROUP BY month(pickup_datetime)
    """,
    "avg_passengers_by_hour": """
        SELECT hour(pickup_datetime) AS hour, avg(passenger_count) AS avg_passenger_count
        FROM silver
        WHERE year = 2023 AND month = 5
          AND year(pickup_datetime) = 2023 AND month(pickup_datetime) = 5
          AND total_amount >= 0
        GROUP BY hour(pickup_datetime)
    """,
}


def build_gold(
    spark: SparkSession, silver: DataFrame, gold_path: str, models: Mapping[str, str] = MODELS
) -> dict[str, DataFrame]:
    """Run SQL models over silver (view ``silver``) and store each as a table."""
    silver.createOrReplaceTempView("silver")
    return {name: write_gold(spark, sql, f"{gold_path}/{name}") for name, sql in models.items()}
