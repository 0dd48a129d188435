from pyspark.sql import functions as F

from meterline.config import TRIP_DICTIONARY, TRIPS
from meterline.functions.names import snake_case, snake_case_text
from meterline.operators import columns as cols
from meterline.plans.steps import Context, run_steps
from tests.trips import yellow, yellow_row

NAMES = {
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "VendorID": "vendor_id",
    "RatecodeID": "ratecode_id",
    "tpep_pickup_datetime": "tpep_pickup_datetime",
    "Airport_fee": "airport_fee",
    "area2Zone": "area2_zone",
    "ABCDef": "abc_def",
}


def test_snake_case_for_names_and_text_agree(spark):
    assert {n: snake_case(n) for n in NAMES} == NAMES
    df = spark.createDataFrame([(n,) for n in NAMES], "n string")
    assert {r.n: r.s for r in df.select("n", snake_case_text("n").alias("s")).collect()} == NAMES


def test_canonical_names_leave_unknown_columns(spark):
    df = spark.createDataFrame([(1, 2)], "pu_location_id int, other int")
    assert cols.canonical_names(df, TRIPS).columns == ["pickup_location_id", "other"]


def test_origin_from_stem(spark):
    stems = ["yellow_tripdata_2023-01", "green_x", "green_yellow", "Yellow_x", "fhv"]
    df = spark.createDataFrame([(s,) for s in stems], "stem string")
    tagged = cols.tag_origin(df, TRIPS, F.col("stem"))
    assert [(r.origin, r.origin_id) for r in tagged.collect()] == [
        ("TPEP", 1), ("LPEP", 2), ("TPEP", 1), ("UNKNOWN", 99), ("UNKNOWN", 99),
    ]
    assert dict(tagged.dtypes)["origin_id"] == "tinyint"
    assert cols.tag_origin(df.limit(1), TRIPS, "green_a").first().origin == "LPEP"


def test_casts_truncate_and_overflow_to_null(spark):
    df = yellow(spark, yellow_row(VendorID=200, passenger_count=1.7))
    row = run_steps(df, Context(stem="yellow"), ["snake_names", "canonical_names", "cast_types"])
    assert dict(row.dtypes)["pickup_location_id"] == "smallint"
    assert dict(row.dtypes)["pickup_datetime"] == "timestamp"
    first = row.first()
    assert first.vendor_id is None and first.passenger_count == 1


def test_decode_hits_misses_and_nulls(spark):
    df = spark.createDataFrame([(1,), (99,), (42,), (None,)], "ratecode_id tinyint")
    decoded = cols.decode_codes(df, TRIPS)
    assert decoded.columns == ["ratecode_id", "ratecode"]
    assert [r.ratecode for r in decoded.collect()] == ["Standard rate", "Null/unknown", None, None]


def test_descriptions_survive_parquet(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "vendor_id tinyint, other int")
    cols.describe_columns(df, TRIP_DICTIONARY).write.parquet(str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t")).schema
    assert "7 = Helix" in back["vendor_id"].metadata["comment"]
    assert "comment" not in back["other"].metadata


def test_prune_null_columns(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    assert cols.prune_null_columns(df).columns == ["a"]


def test_speed_is_null_without_elapsed_seconds(spark):
    df = spark.sql(
        "SELECT timestamp'2023-01-01 00:00:00' a, timestamp'2023-01-01 00:00:00.5' b, 1.0D m "
        "UNION ALL SELECT timestamp'2023-01-01 00:00:00', timestamp'2023-01-01 00:30:00', 10.0D"
    )
    assert [r.mph for r in cols.add_speed(df, "a", "b", "m").collect()] == [None, 20.0]


def test_fitting_cast_equals_try_cast(spark):
    numbers = "127.0D, 127.9D, 128.0D, -128.9D, -129.0D, 1.7D, -0.9D, double('NaN'), double('Infinity'), 1e300D, NULL"
    longs = "127L, 128L, -128L, -129L, 9223372036854775807L, NULL"
    for kind in ("tinyint", "smallint", "int"):
        for source, values in (("double", numbers), ("bigint", longs)):
            df = spark.sql(f"SELECT explode(array({values})) AS v").withColumn("w", F.col("v"))
            df = cols.cast_types(df.withColumn("x", F.col("v").try_cast(kind)), {"w": kind})
            assert dict(df.dtypes)["v"] == source and dict(df.dtypes)["w"] == kind
            assert df.filter(~F.col("w").eqNullSafe(F.col("x"))).count() == 0
    text = cols.cast_types(spark.createDataFrame([("12",), ("x",)], "w string"), {"w": "int"})
    assert [r.w for r in text.collect()] == [12, None]
