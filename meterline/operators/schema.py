"""Schemas as tables: dictionary, gaps, overlap, drift and history.

Rows come from ``df.schema``; the value counts beside them come from one
aggregate over the data, so a column that exists but is empty shows. Without
counts nothing is read, and tables of files get both from their footers
(:func:`meterline.sources.footers.schema_of_files`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.lookups import text_literal
from meterline.operators.columns import non_null_counts


def schema_table(df: DataFrame, dictionary: Mapping[str, str] | None = None, counted: bool = True) -> DataFrame:
    """One row per column: name, position, type, description, number of values (NULL, and no data read, if not ``counted``)."""
    values = "`{}`" if counted else "CAST(NULL AS BIGINT)"
    rows = [
        f"struct({text_literal(f.name)} AS column_name, {position} AS position, "
        f"{text_literal(f.dataType.simpleString())} AS type, "
        f"{text_literal((dictionary or {}).get(f.name, f.metadata.get('comment')))} AS description, "
        f"{values.format(f.name)} AS n_values)"
        for position, f in enumerate(df.schema.fields, start=1)
    ]
    one = non_null_counts(df) if counted else df.sparkSession.range(1)
    return one.selectExpr(f"inline(array({', '.join(rows)}))")


def schema_lines(df: DataFrame) -> DataFrame:
    """The printed schema as rows, in the order of its lines."""
    lines = df._jdf.schema().treeString().rstrip("\n").split("\n")
    return df.sparkSession.createDataFrame(list(enumerate(lines)), "position int, line string")


def data_dictionary(tables: Mapping[str, DataFrame], dictionary: Mapping[str, str] | None = None, counted: bool = True) -> DataFrame:
    """The schema tables of several tables under one ``table_name`` column."""
    parts = [
        schema_table(df, dictionary, counted).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def dictionary_gaps(schema: DataFrame, dictionary: Mapping[str, str]) -> DataFrame:
    """Columns the dictionary does not describe."""
    described = schema.sparkSession.createDataFrame(
        list(dictionary.items()), "column_name string, description string"
    )
    return schema.join(described, "column_name", "left_anti")


def schema_overlap(schemas: DataFrame, by: Sequence[str] = (), kind: str = "kind") -> DataFrame:
    """Which kinds have each column: the common ones have all kinds.

    ``schemas`` holds one row per (by, kind, column_name).
    """
    per_column = schemas.groupBy(*by, "column_name").agg(
        F.array_sort(F.collect_set(kind)).alias("kinds")
    )
    n_kinds = schemas.groupBy(*by).agg(F.count_distinct(kind).alias("n_kinds"))
    if by:
        joined = per_column.join(n_kinds, list(by))
    else:
        total = F.lit(n_kinds.first()["n_kinds"])
        joined = per_column.withColumn("n_kinds", total)
    return joined.withColumn("is_common", F.size("kinds") == F.col("n_kinds")).drop("n_kinds")


def overlap_counts(overlap: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per group: common columns, columns in all, and columns only one kind has."""
    return overlap.groupBy(*by).agg(
        F.count_if("is_common").alias("n_common"),
        F.count_if(F.size("kinds") == 1).alias("n_single"),
        F.count("*").alias("n_columns"),
    )


def only_in_kind(overlap: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per group and kind: how many columns only that kind has, and which."""
    single = overlap.filter(F.size("kinds") == 1).withColumn("only_in", F.col("kinds")[0])
    return single.groupBy(*by, "only_in").agg(
        F.count("*").alias("n_columns"), F.array_sort(F.collect_set("column_name")).alias("columns")
    )


def drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Compare two schema tables: columns added, dropped, retyped or unchanged."""
    left = old.select("column_name", F.col("type").alias("old_type"), F.col("n_values").alias("old_values"))
    right = new.select("column_name", F.col("type").alias("new_type"), F.col("n_values").alias("new_values"))
    change: Column = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "dropped")
        .when(F.col("old_type") != F.col("new_type"), "retyped")
        .otherwise("unchanged")
    )
    return left.join(right, "column_name", "full_outer").withColumn("change", change)


def schema_history(snapshots: DataFrame, taken: str = "taken_at") -> DataFrame:
    """Versions of a schema as validity intervals: a row per column, type and unbroken run of snapshots.

    ``snapshots`` are schema tables under the time they were taken. An interval
    holds from its first snapshot until the next one that has the column no more,
    or in another type; NULL means still. ``first_seen`` and ``last_seen`` are the
    column's over all its intervals. Work is on a row per snapshot and column.
    """
    times = snapshots.select(taken).distinct()
    along = Window.orderBy(taken)  # a row per snapshot
    numbered = times.select(F.col(taken).alias("_at"), F.row_number().over(along).alias("_n"), F.lead(taken).over(along).alias("_next"))
    rows = snapshots.select(F.col(taken).alias("_at"), "column_name", "type").distinct().join(F.broadcast(numbered), "_at")
    run = F.col("_n") - F.row_number().over(Window.partitionBy("column_name", "type").orderBy("_n"))
    runs = rows.withColumn("_run", run).groupBy("column_name", "type", "_run").agg(
        F.min("_at").alias("valid_from"), F.max_by("_next", "_n").alias("valid_to"), F.max("_at").alias("_last")
    )
    whole = Window.partitionBy("column_name")
    seen = {"first_seen": F.min("valid_from").over(whole), "last_seen": F.max("_last").over(whole)}
    return runs.withColumns(seen).drop("_run", "_last")


def schema_as_of(history: DataFrame, moment: Column) -> DataFrame:
    """Columns and types as they were at a time."""
    holds = (F.col("valid_from") <= moment) & (F.col("valid_to").isNull() | (F.col("valid_to") > moment))
    return history.filter(holds).select("column_name", "type")


def drift_between(history: DataFrame, old: Column, new: Column) -> DataFrame:
    """What changed between any two times: columns added, dropped, retyped or unchanged."""
    sides = [schema_as_of(history, moment).withColumn("n_values", F.lit(None).cast("bigint")) for moment in (old, new)]
    return drift(*sides).drop("old_values", "new_values")


def dataset_facets(
    df: DataFrame,
    name: str,
    dictionary: Mapping[str, str] | None = None,
    *,
    namespace: str = "meterline",
    file_format: str = "parquet",
    source_uri: str = "",
    owner: str = "",
    overwritten: bool = False,
    schema: DataFrame | None = None,
) -> DataFrame:
    """A snapshot of one dataset: per-column facts plus where it lives and who owns it.

    ``schema`` gives a schema table that is there already, from footers for instance; ``df`` is then not read.
    """
    change = "OVERWRITE" if overwritten else None
    known = schema_table(df, dictionary) if schema is None else _described(schema, dictionary)
    return known.select(
        F.lit(namespace).alias("namespace"),
        F.lit(name).alias("dataset"),
        F.lit(source_uri).alias("source_uri"),
        F.lit(file_format).alias("file_format"),
        F.lit(owner).alias("owner"),
        F.lit(change).cast("string").alias("lifecycle_change"),
        "column_name",
        "position",
        "type",
        "description",
        "n_values",
    )


def _described(schema: DataFrame, dictionary: Mapping[str, str] | None) -> DataFrame:
    words = schema.sparkSession.createDataFrame(list((dictionary or {}).items()), "column_name string, description string")
    return schema.drop("description").join(F.broadcast(words), "column_name", "left")  # a row per described column
