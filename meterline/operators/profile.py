"""Column profiles, whole-table checks and output statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.operators.columns import non_null_counts
from meterline.operators.ordered import kept


def _by_itself(field: T.StructField) -> Column:
    """The column in a form that can be grouped and that parquet can hold; text only where there is no other."""
    kind = field.dataType
    plain = isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.BinaryType, T.TimestampType, T.TimestampNTZType))
    return F.col(field.name) if plain else _as_text(field)


def _as_text(field: T.StructField) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(column)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return (column + F.lit(0.0)).cast("string")  # one text for 0.0 and -0.0
    if isinstance(field.dataType, T.BinaryType):
        return F.hex(column)
    return column.cast("string")


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Per column: distinct values (NULL counts as one), rows and their ratio.

    The exact form groups each column by itself and in its own type, so that few
    values take little memory in the map tasks beside a column of many, and
    repeated ones cost no shuffle. It reads the frame once a column: one that is
    more than columns and filters of scans is written to scratch first. The approximate
    form keeps one sketch per column and shuffles nothing else. Of an empty table
    the exact form has no row, the approximate one zeros and no ratio.
    """
    fields = df.schema.fields
    if approximate:
        sketches = [
            (F.approx_count_distinct(_as_text(f)) + F.coalesce(F.max(F.col(f.name).isNull().cast("int")), F.lit(0))).alias(f.name)
            for f in fields
        ]
        wide = df.agg(F.count("*").alias("_rows"), *sketches)
        names = [f.name for f in fields]
        longer = wide.unpivot(["_rows"], names, "column_name", "n_unique")
        profile = longer.select("column_name", "n_unique", F.col("_rows").alias("n_rows"))
    else:
        numbered = {f.name: f"c{k}" for k, f in enumerate(fields)}
        values = kept(df.select(*(_by_itself(f).alias(numbered[f.name]) for f in fields)), "profiled")
        counted = [
            values.groupBy(c).agg(F.count("*").alias("copies")).select(F.lit(name).alias("column_name"), "copies")
            for name, c in numbered.items()
        ]
        profile = reduce(DataFrame.unionAll, counted).groupBy("column_name").agg(F.count("*").alias("n_unique"), F.sum("copies").alias("n_rows"))
    return profile.withColumn("unique_ratio", F.try_divide("n_unique", "n_rows"))


def table_checks(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: for each condition, whether all rows meet it, whether any does, and how many."""
    aggs = []
    for name, condition in conditions.items():
        aggs += [
            F.bool_and(condition).alias(f"all_{name}"),
            F.bool_or(condition).alias(f"any_{name}"),
            F.count_if(condition).alias(f"n_{name}"),
        ]
    return df.agg(*aggs)


def columns_with_values(df: DataFrame) -> DataFrame:
    """One row per column: its number of values and whether it is entirely NULL."""
    counts = non_null_counts(df).unpivot([], df.columns, "column_name", "n_values")
    return counts.withColumn("all_null", F.col("n_values") == 0)


def observe_rows(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows while an action runs over the returned frame."""
    seen = Observation()
    return df.observe(seen, F.count("*").alias("row_count")), seen


def output_statistics(spark, path: str) -> DataFrame:
    """Rows and bytes of a written parquet table. Rows are counted from the
    columnless scan, bytes from the file listing."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .agg(F.sum("length").alias("size_bytes"), F.count("*").alias("n_files"))
    )
    rows = spark.read.parquet(path).agg(F.count("*").alias("row_count"))
    both = rows.unionByName(files, allowMissingColumns=True)
    return both.agg(*(F.max(c).alias(c) for c in both.columns))
