import pytest
from pyspark.sql import functions as F

from meterline.config import TRIPS
from meterline.operators.columns import decode_codes
from meterline.operators.joins import (
    decode_by_join,
    dimension_join,
    duplicate_keys,
    fits_broadcast,
    join_zones,
    orphan_keys,
    star_join,
    star_split,
)
from meterline.operators.union import union_by_name
from meterline.sources.zones import shape_zones
from tests.trips import zones


def facts(spark):
    return spark.createDataFrame(
        [(1, 2), (2, 77), (None, 3)], "pickup_location_id smallint, dropoff_location_id smallint"
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_left_join_keeps_trips_and_key_type(spark):
    joined = join_zones(facts(spark), shape_zones(zones(spark)))
    assert joined.count() == 3
    assert dict(joined.dtypes)["pickup_location_id"] == "smallint"
    assert set(joined.columns) == {
        f"{r}_{c}" for r in ("pickup", "dropoff") for c in ("location_id", "borough", "zone", "service_zone")
    }
    row = joined.filter("pickup_location_id = 2").first()
    assert row.pickup_borough == "N/A" and row.dropoff_borough is None


def test_inner_join_drops_unknown_zones(spark):
    assert join_zones(facts(spark), shape_zones(zones(spark)), how="inner").count() == 1


def test_repeated_dimension_rows_do_not_multiply_trips(spark):
    dim = shape_zones(zones(spark))
    assert join_zones(facts(spark), dim.unionByName(dim)).count() == 3


def test_broadcast_only_when_measured_small(spark):
    dim = shape_zones(zones(spark))
    assert fits_broadcast(dim) and not fits_broadcast(dim, max_rows=2) and not fits_broadcast(dim, max_bytes=50)
    small = dimension_join(facts(spark), dim, "pickup_location_id", "location_id")
    assert "BroadcastHashJoin" in plan(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = dimension_join(facts(spark), dim, "pickup_location_id", "location_id", broadcast=False)
        assert "SortMergeJoin" in plan(large)
        assert sorted(map(str, large.collect())) == sorted(map(str, small.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_decode_by_join_equals_decode_by_map(spark):
    df = spark.createDataFrame([(1, 3), (99, None), (42, 0)], "ratecode_id tinyint, payment_type_id tinyint")
    left, right = decode_codes(df, TRIPS), decode_by_join(df, TRIPS)
    assert left.exceptAll(right.select(*left.columns)).count() == 0


def test_orphans_ignore_null_keys(spark):
    found = orphan_keys(facts(spark), shape_zones(zones(spark)), "dropoff_location_id", "location_id")
    assert [tuple(r) for r in found.collect()] == [(77, 1)]
    assert orphan_keys(facts(spark), shape_zones(zones(spark)), "pickup_location_id", "location_id").count() == 0


def test_star_split_joins_back(spark, tmp_path):
    base = facts(spark).withColumns({"ratecode_id": F.lit(2).cast("tinyint"), "origin_id": F.lit(1), "origin": F.lit("TPEP")})
    wide = join_zones(decode_codes(base, TRIPS), shape_zones(zones(spark)))
    tables = star_split(wide, TRIPS)
    assert set(tables) == {"fact", "ratecode_id", "origin_id", "zone"}
    assert "pickup_zone" not in tables["fact"].columns
    again = star_join(tables, TRIPS).select(*wide.columns)
    assert wide.exceptAll(again).count() == 0 and again.exceptAll(wide).count() == 0
    wide.write.parquet(str(tmp_path / "wide"))
    again = plan(star_join(star_split(spark.read.schema(wide.schema).parquet(str(tmp_path / "wide")), TRIPS), TRIPS))
    assert "SortMergeJoin" not in again and again.count("BroadcastHashJoin") == 4  # the fact does not move
    assert {n: t.count() for n, t in tables.items()} == {"fact": 3, "ratecode_id": 1, "origin_id": 1, "zone": 4}
    assert dict(tables["ratecode_id"].dtypes) == {"ratecode_id": "tinyint", "ratecode": "string"}


def test_duplicate_keys(spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "key int, text string")
    assert [tuple(r) for r in duplicate_keys(dim, "key").collect()] == [(1, 2)]


def test_union_orders_and_fills(spark):
    a = spark.createDataFrame([(1, "x")], "b int, a string")
    b = spark.createDataFrame([(2.5, "y")], "b double, c string")
    assert union_by_name([a, b]).columns == ["b", "a", "c"]
    assert union_by_name([b, a]).columns == ["b", "c", "a"]
    rows = [tuple(r) for r in union_by_name([a, b]).collect()]
    assert rows == [(1.0, "x", None), (2.5, None, "y")]
    assert union_by_name([a]) is a
    with pytest.raises(ValueError):
        union_by_name([])


def test_relaxed_union_turns_mixed_columns_into_text(spark):
    a, b = spark.createDataFrame([(1,)], "v int"), spark.createDataFrame([("one",)], "v string")
    assert [r.v for r in union_by_name([a, b], relaxed=True).collect()] == ["1", "one"]
