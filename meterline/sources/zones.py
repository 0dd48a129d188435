"""The taxi zone dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterline.config import ZONE_DICTIONARY, ZONE_TYPES
from meterline.operators.columns import cast_types, describe_columns, snake_names


def shape_zones(zones: DataFrame) -> DataFrame:
    """Snake-case names, the four typed columns, descriptions attached."""
    typed = cast_types(snake_names(zones), ZONE_TYPES).select(*ZONE_TYPES)
    return describe_columns(typed, ZONE_DICTIONARY)


def read_zones(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Read the zone CSV as text, then type it. ``N/A`` is a value, not a NULL."""
    raw = spark.read.option("header", True).option("sep", sep).csv(path)
    return shape_zones(raw)
