"""Dimension joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.config import TableSpec
from meterline.operators.columns import prefix_columns
from meterline.session import scratch_path

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(
    dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Measure the dimension, reading at most ``max_rows`` + 1 rows of it."""
    width = F.octet_length(F.to_json(F.struct("*")))
    seen = dim.limit(max_rows + 1).agg(F.count("*").alias("n"), F.sum(width).alias("bytes")).first()
    return seen["n"] <= max_rows and (seen["bytes"] or 0) <= max_bytes


def dimension_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    how: str = "left",
    broadcast: bool | None = None,
) -> DataFrame:
    """Add the dimension's columns, keeping the fact's own key column.

    A measured small dimension is broadcast. A larger one is joined by shuffle,
    where AQE cuts the partitions of hot keys into pieces.
    """
    if broadcast is None:
        broadcast = fits_broadcast(dim)
    keyed = dim.withColumnRenamed(dim_key, "_dim_key")
    side = F.broadcast(keyed) if broadcast else keyed
    return fact.join(side, F.col(fact_key) == F.col("_dim_key"), how).drop("_dim_key")


def join_zones(
    df: DataFrame,
    zones: DataFrame,
    roles: Sequence[str] = ("pickup", "dropoff"),
    how: str = "left",
    broadcast: bool | None = None,
) -> DataFrame:
    """Join the zone dimension once per role, under that role's column prefix.

    The dimension is made distinct first: with distinct facts on the other side
    the result then equals removing duplicates after the joins, which would
    shuffle the zone texts too.
    """
    distinct = zones.dropDuplicates()
    small = fits_broadcast(distinct) if broadcast is None else broadcast
    for role in roles:
        key = f"{role}_location_id"
        df = dimension_join(df, prefix_columns(distinct, f"{role}_"), key, key, how, broadcast=small)
    return df


def code_dimensions(df: DataFrame, spec: TableSpec) -> dict[str, DataFrame]:
    """The code lists as (id, text) tables, ids typed as in the fact table."""
    spark = df.sparkSession
    return {
        id_column: spark.createDataFrame(
            list(codes.items()), f"{id_column} int, {spec.text_column(id_column)} string"
        ).withColumn(id_column, F.col(id_column).cast(spec.types.get(id_column, "int")))
        for id_column, codes in spec.codes.items()
    }


def decode_by_join(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Decode through the code tables instead of map literals. The tables hold
    the few codes of the spec, so they are always small."""
    for id_column, dim in code_dimensions(df, spec).items():
        if id_column in df.columns:
            df = dimension_join(df, dim, id_column, id_column, broadcast=True)
    return df


def orphan_keys(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact keys the dimension lacks, with their row counts. A NULL key refers to nothing.

    Facts are counted per key before the join, so no key is hot in it.
    """
    counts = (
        fact.filter(F.col(fact_key).isNotNull()).groupBy(fact_key).agg(F.count("*").alias("n_rows"))
    )
    return counts.join(dim, F.col(fact_key) == F.col(dim_key), "left_anti")


def star_split(wide: DataFrame, spec: TableSpec) -> dict[str, DataFrame]:
    """Wide table to ``fact`` plus one table per code list and one ``zone`` table.

    Dimensions come from the data (distinct id and text), so they hold what the
    fact refers to. All of them are found in one pass over the table and stored,
    so that joining them again reads a few rows and can measure them first.
    """
    pairs = {c: spec.text_column(c) for c in spec.codes if c in wide.columns}
    pairs["origin_id"] = "origin"
    zone_texts = ("borough", "zone", "service_zone")
    pairs = {c: text for c, text in pairs.items() if c in wide.columns}
    roles = [r for r in spec.zone_roles if f"{r}_zone" in wide.columns]
    entries = [_member(id_column, id_column, [text]) for id_column, text in pairs.items()]
    entries += [_member("zone", f"{role}_location_id", [f"{role}_{text}" for text in zone_texts]) for role in roles]
    tables = {}
    if entries:
        members = _stored_members(wide, entries)
        for id_column, text in pairs.items():
            own = F.col("id").cast(wide.schema[id_column].dataType).alias(id_column)
            tables[id_column] = members.filter(F.col("dimension") == id_column).select(own, F.col("texts")[0].alias(text))
        if roles:
            own = F.col("id").cast(wide.schema[f"{roles[0]}_location_id"].dataType).alias("location_id")
            texts = [F.col("texts")[k].alias(text) for k, text in enumerate(zone_texts)]
            tables["zone"] = members.filter("dimension = 'zone'").select(own, *texts)
    derived = [*pairs.values(), *(f"{role}_{text}" for role in roles for text in zone_texts)]
    return {"fact": wide.drop(*derived), **tables}


def _member(dimension: str, id_column: str, texts: Sequence[str]) -> Column:
    return F.struct(F.lit(dimension).alias("dimension"), F.col(id_column).cast("bigint").alias("id"), F.array(*texts).alias("texts"))


def _stored_members(wide: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """The distinct members of all dimensions, by one pass and one shuffle of what the map tasks found."""
    rows = wide.select(F.explode(F.array(*entries)).alias("m")).select("m.*").filter("id IS NOT NULL").distinct()
    path = scratch_path(wide.sparkSession, "dimensions")
    rows.write.parquet(path)
    return wide.sparkSession.read.schema(rows.schema).parquet(path)


def star_join(tables: dict[str, DataFrame], spec: TableSpec) -> DataFrame:
    """The inverse of :func:`star_split`.

    Each dimension is measured; small ones are broadcast, and then the fact does not move at all.
    """
    df = tables["fact"]
    for name, dim in tables.items():
        if name not in ("fact", "zone"):
            df = dimension_join(df, dim, name, name)
    if "zone" in tables:
        df = join_zones(df, tables["zone"], spec.zone_roles)
    return df


def duplicate_keys(dim: DataFrame, key: str) -> DataFrame:
    """Keys that more than one row of a dimension has, with their number: a join would multiply facts by it."""
    return dim.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")
