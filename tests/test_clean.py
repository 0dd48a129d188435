from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from meterline.functions.rules import trip_rules
from checks.landing import land
from meterline.operators.clean import BROKEN, clean, drop_copies, drop_copies_by_digest, keep_rows, mark_rows, quarantine_split, reject_report, row_digest, split_by_copies
from meterline.plans.steps import Context, run_steps
from meterline.plans.trips import run_pipeline
from meterline.sources.files import list_files
from tests.trips import NOON, green, green_row, yellow, yellow_row, zones

CONFORM = ["snake_names", "canonical_names", "tag_origin", "cast_types"]


def conformed(spark, *rows):
    return run_steps(yellow(spark, *rows), Context(stem="yellow"), CONFORM)


def drop_at(**delta):
    return {"tpep_dropoff_datetime": NOON + timedelta(**delta)}


KEPT_OR_NOT = [
    ({}, True),
    ({"passenger_count": None}, False),
    ({"passenger_count": -1.0}, False),
    ({"passenger_count": 0.0}, True),
    ({"passenger_count": 6.0}, True),
    ({"passenger_count": 7.0}, False),
    ({"passenger_count": 200.0}, False),
    ({"RatecodeID": None}, False),
    ({"RatecodeID": 99.0}, False),
    ({"tpep_dropoff_datetime": None}, False),
    ({"tpep_pickup_datetime": None}, False),
    (drop_at(seconds=0), False),
    (drop_at(seconds=-5), False),
    (drop_at(milliseconds=500), False),  # passes the duration rule, has no speed
    (drop_at(hours=12), True),
    (drop_at(hours=12, milliseconds=500), True),
    (drop_at(hours=12, seconds=1), False),
    ({"payment_type": 3}, False),
    ({"payment_type": 3, "fare_amount": -1.0}, True),
    ({"payment_type": 3, "fare_amount": 0.0}, True),
    ({"payment_type": 3, "fare_amount": None}, False),
    ({"payment_type": None}, False),
    ({"payment_type": None, "fare_amount": -1.0}, True),
    ({"payment_type": 1, "fare_amount": None}, True),
    ({"trip_distance": 0.0}, False),
    ({"trip_distance": 0.0, "RatecodeID": 5.0}, True),
    ({"trip_distance": 0.0, "fare_amount": -1.0}, True),
    ({"trip_distance": None}, False),
    ({"trip_distance": float("nan")}, False),
    ({"trip_distance": 11.0}, True),
    ({"trip_distance": 12.0}, False),  # 72 mph
    ({"VendorID": 200}, True),
    ({"trip_distance": -1.0}, True),
]


def test_every_rule_and_null(spark):
    rows = [yellow_row(**change, PULocationID=i) for i, (change, _) in enumerate(KEPT_OR_NOT)]
    kept = keep_rows(conformed(spark, *rows), trip_rules())
    got = {r.pickup_location_id for r in kept.collect()}
    assert got == {i for i, (_, stays) in enumerate(KEPT_OR_NOT) if stays}


def test_exact_duration_option(spark):
    df = conformed(spark, yellow_row(**drop_at(hours=12, milliseconds=500)), yellow_row(**drop_at(hours=12)))
    assert keep_rows(df, trip_rules()).count() == 2
    assert keep_rows(df, trip_rules(exact_duration=True)).count() == 1


def test_copies_are_found_after_the_cast_and_before_the_drop(spark):
    rows = [green_row(passenger_count=2.1), green_row(passenger_count=2.9), green_row(ehail_fee=1.0)]
    df = run_steps(green(spark, *rows), Context(stem="green"), CONFORM)
    cleaned = clean(df, trip_rules(), ("ehail_fee", "not_there"))
    assert "ehail_fee" not in cleaned.columns
    assert cleaned.count() == 2  # the fee still told two rows apart


def test_filter_before_dedup_shuffles_once(spark):
    plan = clean(conformed(spark, yellow_row()), trip_rules())._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("Exchange hashpartitioning") == 1


def test_clean_is_idempotent(spark):
    df = conformed(spark, *(yellow_row(**c) for c, _ in KEPT_OR_NOT))
    once = clean(df, trip_rules())
    assert once.exceptAll(clean(once, trip_rules())).count() == 0


def test_quarantine_covers_the_distinct_input(spark):
    rows = [yellow_row(**change) for change, _ in KEPT_OR_NOT]
    df = conformed(spark, *rows, *rows)
    accepted, rejected = quarantine_split(df, trip_rules())
    assert accepted.unionByName(rejected.drop("broken")).exceptAll(drop_copies(df)).count() == 0
    assert accepted.count() + rejected.count() == drop_copies(df).count()
    assert rejected.filter(F.size("broken") == 0).count() == 0


def test_reject_report_counts_overlaps(spark):
    df = conformed(spark, yellow_row(passenger_count=9.0, RatecodeID=99.0), yellow_row(passenger_count=8.0))
    report = {r.rule: r.rejected_rows for r in reject_report(df, trip_rules()).collect()}
    assert report["passengers_in_range"] == 2 and report["rate_known"] == 1 and report["speed_possible"] == 0


@pytest.mark.parametrize("source,expected", [(False, 1), (True, 2)])
def test_copies_across_files_stay_when_the_file_is_a_column(spark, source, expected):
    df = conformed(spark, yellow_row())
    both = df.withColumn("f", F.lit("a")).unionByName(df.withColumn("f", F.lit("b")))
    assert drop_copies(both if source else both.drop("f")).count() == expected


@pytest.mark.parametrize("digest", [None, "0", "id % 3"])
@pytest.mark.parametrize("most", [1_000_000, 1])
def test_copies_by_digest_equal_whole_rows(spark, digest, most):
    rows = [(1, None, 1.5, [1]), (1, None, 1.5, [1]), (None, 1, 1.5, [1]), (2, 2, float("nan"), None), (2, 2, float("nan"), None), (3, 3, 0.0, []), (3, 3, -0.0, []), (4, 4, None, [None])]
    df = spark.createDataFrame(rows, "id int, other int, x double, list array<int>")
    digest = digest and F.expr(digest)
    want = sorted(map(str, drop_copies(df).collect()))
    assert sorted(map(str, drop_copies_by_digest(df, digest, most).collect())) == want and len(want) == 5
    assert drop_copies_by_digest(df.limit(0), digest, most).count() == 0


def test_only_repeated_rows_are_shuffled(spark):
    df = spark.range(1000).selectExpr("id", "repeat('wide', 50) AS text")
    plan = drop_copies_by_digest(df)._jdf.queryExecution().optimizedPlan().toString()
    alone = plan.split("Aggregate")[0]
    assert "Join LeftAnti" in alone and "strategy=broadcast" in alone


def test_marked_rows_are_told_apart_by_digests(spark):
    df = spark.range(1000).selectExpr("id % 900 AS id", "repeat('wide', 50) AS text")
    marked = mark_rows(df, {"small": F.col("id") < 10})
    assert marked.count() == 900 and marked.filter(F.size(BROKEN) == 0).count() == 10
    assert "Join LeftAnti" in marked._jdf.queryExecution().optimizedPlan().toString()


def test_landing_moves_rows_with_copies_only(spark, tmp_path):
    copies = spark.range(40, numPartitions=4).selectExpr("id % 10 AS id", "'x' AS text")
    df = copies.unionAll(spark.range(100, 140, 1, 4).selectExpr("id", "'y' AS text")).unionAll(copies.limit(0))
    alone, copied = split_by_copies(df)
    assert (alone.count(), copied.count()) == (40, 40)
    land(df, str(tmp_path), "yellow_tripdata_2023-01")
    landed = spark.read.parquet(str(tmp_path)).select("*", F.col("_metadata.file_name").alias("file"))
    assert landed.count() == 80 and landed.groupBy("id").agg(F.count_distinct("file").alias("n")).filter("n > 1").count() == 0
    assert landed.select("file").distinct().count() == len(list(tmp_path.glob("*.parquet")))


def test_landed_copies_have_no_file_to_themselves(spark, tmp_path):
    """Two equal rows, which cleaning drops, would make a file that keeps no row and so breaks the contract."""
    good = [yellow_row(fare_amount=float(i)) for i in range(1, 3000)]
    bad = yellow_row(passenger_count=9.0)
    land(yellow(spark, *good, bad, bad), str(tmp_path / "landed"), "yellow_tripdata_2023-01")
    files = list_files(spark, f"{tmp_path}/landed/*.parquet")
    per_file = spark.read.parquet(*files).groupBy(F.col("_metadata.file_name"), (F.col("passenger_count") == 9).alias("bad")).count().collect()
    assert sum(r["count"] for r in per_file) == 3001 and [r["count"] for r in per_file if r.bad] == [2]
    assert {r.file_name for r in per_file if r.bad} <= {r.file_name for r in per_file if not r.bad}
    trips = run_pipeline(spark, files, zone_lookup=zones(spark))
    assert trips.count() == 2999


def test_digests_tell_nulls_apart_by_their_place_in_wide_rows(spark):
    wide = spark.range(40).select(*(F.when(F.col("id") != k, 1).alias(f"c{k}") for k in range(40)))
    assert drop_copies_by_digest(wide).count() == 40
    assert wide.select(row_digest(wide.columns).alias("d")).distinct().count() == 40
