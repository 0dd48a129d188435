"""Column operators: naming, typing, tagging, decoding, describing.

Each is one ``select``-like call, so a frame with many columns is analysed once
and every expression stays in the scan's generated code.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.config import TableSpec
from meterline.functions.clocks import calendar_parts, elapsed_seconds, miles_per_hour
from meterline.functions.lookups import decode
from meterline.functions.names import snake_case


def snake_names(df: DataFrame) -> DataFrame:
    return df.toDF(*map(snake_case, df.columns))


def canonical_names(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.withColumnsRenamed(dict(spec.renames))


def origin_columns(spec: TableSpec, stem: Column) -> dict[str, Column]:
    """Origin name and code by the first marker the (case-sensitive) stem contains."""
    name, code = F.lit(spec.unknown_origin.name), F.lit(spec.unknown_origin.code)
    for origin in reversed(spec.origins):
        found = stem.contains(origin.marker)
        name = F.when(found, F.lit(origin.name)).otherwise(name)
        code = F.when(found, F.lit(origin.code)).otherwise(code)
    return {"origin": name, "origin_id": code.cast("tinyint")}


def tag_origin(df: DataFrame, spec: TableSpec, stem: str | Column) -> DataFrame:
    """``stem`` is a file stem, or the column that holds it when many files share a scan."""
    return df.withColumns(origin_columns(spec, F.lit(stem) if isinstance(stem, str) else stem))


# The whole numbers each type can hold.
INTEGER_RANGES = {
    "tinyint": (-128, 127),
    "smallint": (-32768, 32767),
    "int": (-2147483648, 2147483647),
}


def fitting_cast(column: Column, source: T.DataType, kind: str) -> Column:
    """Cast; a value that does not fit becomes NULL, a fraction is cut off.

    ``try_cast`` does this by raising and catching an exception for each value
    that does not fit, about 14 microseconds. Numbers are compared first instead.
    """
    if isinstance(source, T.NumericType) and kind in INTEGER_RANGES:
        low, high = INTEGER_RANGES[kind]
        return F.when((column > low - 1) & (column < high + 1), column.cast(kind))
    if isinstance(source, (T.TimestampType, T.TimestampNTZType, T.DateType)) and kind == "timestamp":
        return column.cast(kind)
    return column.try_cast(kind)


def cast_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the columns that are present and not yet of their type."""
    present = {
        name: fitting_cast(F.col(name), df.schema[name].dataType, kind)
        for name, kind in types.items()
        if name in df.columns and df.schema[name].dataType.simpleString() != kind
    }
    return df.withColumns(present) if present else df


def decode_codes(df: DataFrame, spec: TableSpec) -> DataFrame:
    present = {spec.text_column(c): decode(c, m) for c, m in spec.codes.items() if c in df.columns}
    return df.withColumns(present) if present else df


def order_columns(df: DataFrame) -> DataFrame:
    return df.select(*sorted(df.columns))


def add_calendar(df: DataFrame, ts: str, *parts: str) -> DataFrame:
    return df.withColumns(calendar_parts(ts, *(parts or ("year", "month"))))


def add_speed(df: DataFrame, start: str, end: str, miles: str) -> DataFrame:
    """Adds ``elapsed_seconds`` and ``mph``."""
    seconds = elapsed_seconds(start, end)
    return df.withColumns({"elapsed_seconds": seconds, "mph": miles_per_hour(miles, seconds)})


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*(prefix + name for name in df.columns))


def describe_columns(df: DataFrame, dictionary: Mapping[str, str]) -> DataFrame:
    """Put descriptions into the column metadata, where parquet keeps them.

    A cast drops metadata, so this belongs at the end of a pipeline.
    """
    return df.select(
        *(
            F.col(c).alias(c, metadata={**df.schema[c].metadata, "comment": dictionary[c]})
            if c in dictionary
            else F.col(c)
            for c in df.columns
        )
    )


def non_null_counts(df: DataFrame) -> DataFrame:
    """One row: how many values each column has."""
    return df.agg(*(F.count(F.col(c)).alias(c) for c in df.columns))


def prune_null_columns(df: DataFrame) -> DataFrame:
    """Drop the columns that hold no value at all (one pass, one row to the driver)."""
    counts = non_null_counts(df).first()
    return df.select(*(c for c in df.columns if counts[c] > 0))
