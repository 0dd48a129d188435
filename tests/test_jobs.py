from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from meterline.operators.columns import add_calendar
from meterline.operators.validate import trip_contract
from meterline.plans.steps import DEFAULT_STEPS, REGISTRY, Context, resolve, run_steps, step
from meterline.operators.lineage import failures, invalid_transitions, run_tree
from meterline.plans.logged import run_logged
from meterline.plans.trips import run_job, run_pipeline
from meterline.sources.files import file_attributes, file_table, list_files, restore
from meterline.sources.sinks import write_checked, write_csv, write_partitioned
from meterline.sources.trips import read_footers, scan_trips, schema_only
from meterline.sources.zones import read_zones
from tests.trips import NOON, green, green_row, write_file, yellow, yellow_row, zones


@pytest.fixture
def raw(spark, tmp_path):
    folder = tmp_path / "bronze"
    folder.mkdir()
    january = yellow(spark, yellow_row(), yellow_row(), yellow_row(DOLocationID=3), yellow_row(passenger_count=None))
    paths = [
        write_file(green(spark, green_row()), folder, "green_tripdata_2023-01"),
        write_file(january, folder, "yellow_tripdata_2023-01"),
        write_file(yellow(spark, yellow_row()), folder, "yellow_tripdata_2023-02"),
    ]
    return str(folder), paths


def test_steps_by_name(spark):
    assert set(DEFAULT_STEPS) <= set(REGISTRY)
    assert resolve([]) == resolve() == [REGISTRY[s] for s in DEFAULT_STEPS]
    with pytest.raises(ValueError, match="no step is registered as 'nope'; there are .*clean"):
        resolve(["clean", "nope"])
    double = step("double_for_test")(lambda df, ctx: df.withColumn("a", F.col("a") * 2))
    df = spark.createDataFrame([(1,)], "a int")
    assert run_steps(df, Context(), ["double_for_test", double, "order_columns"]).first().a == 4
    del REGISTRY["double_for_test"]


def test_join_step_needs_zones(spark):
    with pytest.raises(ValueError, match="zone"):
        run_steps(spark.range(1), Context(), ["join_zones"])


def test_silver_from_files(spark, raw):
    folder, paths = raw
    assert list_files(spark, f"{folder}/*_tripdata_2023*.parquet") == [f"file:{p}" for p in paths]
    silver = run_pipeline(spark, paths, zone_lookup=zones(spark))
    # Two in January (one copy and one bad row gone), one in February: copies across files stay.
    assert {r.origin: r["count"] for r in silver.groupBy("origin").count().collect()} == {"TPEP": 3, "LPEP": 1}
    assert "ehail_fee" not in silver.columns and silver.columns[-1] == "airport_fee"
    assert silver.schema["vendor"].metadata["comment"]
    green_trip = silver.filter("origin_id = 2").first()
    assert green_trip.trip_type == "Street-hail" and green_trip.dropoff_zone is None
    assert green_trip.airport_fee is None and green_trip.pickup_zone == "East"


def test_files_of_one_schema_share_a_scan(spark, raw):
    _, paths = raw
    scans = scan_trips(spark, paths)
    assert [sorted(s.sources) for s in scans] == [
        ["green_tripdata_2023-01.parquet"], ["yellow_tripdata_2023-01.parquet", "yellow_tripdata_2023-02.parquet"],
    ]


def test_equal_names_in_two_folders_stay_two_files(spark, tmp_path):
    for name in "ab":
        (tmp_path / name).mkdir()
    paths = [write_file(yellow(spark, yellow_row()), tmp_path / n, "yellow_tripdata_2023-01") for n in "ab"]
    assert run_pipeline(spark, paths, zone_lookup=zones(spark)).count() == 2


def test_a_folder_is_one_file(spark, tmp_path):
    path = str(tmp_path / "yellow_tripdata_2023-01.parquet")
    df = yellow(spark, yellow_row())
    df.unionByName(df).repartition(2).write.parquet(path)
    silver = run_pipeline(spark, path, zone_lookup=zones(spark), keep_source=True)
    assert [(r.origin, r._source) for r in silver.collect()] == [("TPEP", path)]


def test_input_kinds(spark, raw):
    with pytest.raises(NotImplementedError):
        scan_trips(spark, ("a", "b"))
    with pytest.raises(ValueError):
        scan_trips(spark, [])
    with pytest.raises(ValueError, match="unreadable"):
        scan_trips(spark, raw[1] + [raw[0] + "/missing.parquet"])
    assert "VendorID" in schema_only(spark, raw[1][0])


def test_contract_is_checked_per_file(spark, raw):
    folder, paths = raw
    empty = write_file(yellow(spark, yellow_row(passenger_count=9.0)), folder, "yellow_tripdata_2023-03")
    with pytest.raises(ValueError, match=r"yellow_tripdata_2023-03.*not_empty"):
        run_pipeline(spark, [*paths, empty], zone_lookup=zones(spark))
    bad = write_file(yellow(spark, yellow_row(VendorID=5), yellow_row()), folder, "yellow_tripdata_2023-04")
    with pytest.raises(ValueError, match=r"yellow_tripdata_2023-04.*in_list.*vendor_id"):
        run_pipeline(spark, [*paths, bad], zone_lookup=zones(spark))
    assert run_pipeline(spark, [*paths, bad], zone_lookup=zones(spark), validation="off").count() == 6


def test_footers_report_broken_files(spark, raw):
    folder, paths = raw
    broken = f"{folder}/broken.parquet"
    with open(broken, "w") as out:
        out.write("not parquet")
    footers = read_footers(spark, [paths[0], broken])
    assert footers[0].error is None and "passenger_count:double" in footers[0].fingerprint
    assert footers[1].error


def test_file_attributes(spark):
    paths = ["/d/yellow/yellow_tripdata_2023-01.parquet", "/d/green_tripdata_2022-12.parquet", "/d/fhv_2023-01.parquet"]
    df = file_attributes(spark.createDataFrame([(p,) for p in paths], "path string"))
    assert [(r.taxi, r.year, r.month) for r in df.collect()] == [("yellow", 2023, 1), ("green", 2022, 12)]


def test_file_attributes_from_anywhere_in_the_path(spark):
    paths = {
        "/d/yellow/tripdata_2023-01.parquet": ("yellow", 2023, 1),
        "/d/nyc_yellow_tripdata_2023-02.parquet": ("yellow", 2023, 2),
        "/d/green-tripdata-2023-03.parquet": ("green", 2023, 3),
        "yellow2023-04.parquet": ("yellow", 2023, 4),
        "/yellow/green_tripdata_2023-05.parquet": ("yellow", 2023, 5),
        "/d/yellow_2023-13.parquet": None,
        "/d/yellow_2023-1.parquet": None,
        "/d/yellow_2023- 1.parquet": None,
        "/d/yellow_2023-01.csv": None,
        "/d/yellow_2023-01.parquet/part-0.parquet": None,
        "/d/2023-01.parquet": None,
        ".parquet": None,
        "x": None,
    }
    got = file_attributes(spark.createDataFrame([(p,) for p in paths], "path string")).collect()
    assert {r.path: (r.taxi, r.year, r.month) for r in got} == {p: v for p, v in paths.items() if v}


def test_zone_csv(spark, tmp_path):
    write_csv(zones(spark), str(tmp_path / "z"), sep=";")
    back = read_zones(spark, str(tmp_path / "z"), sep=";")
    assert dict(back.dtypes)["location_id"] == "int"
    assert {r.location_id: r.borough for r in back.collect()} == {1: "Alpha", 2: "N/A", 3: "Beta"}
    assert back.schema["zone"].metadata["comment"]


def test_partitioned_writes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2023, 1), (2, 2023, 2)], "v int, year int, month int")
    write_partitioned(df, path)
    assert sorted((r.year, r.month) for r in file_table(spark, path).collect()) == [(2023, 1), (2023, 2)]
    write_partitioned(df.filter("v = 2").withColumn("v", F.lit(9)), path, replace="touched")
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 9]
    write_partitioned(df, path, replace="none")
    assert spark.read.parquet(path).count() == 4
    write_partitioned(df.filter("v = 1"), path)
    assert [r.v for r in spark.read.parquet(path).collect()] == [1]


def test_the_job_publishes_only_valid_tables(spark, raw, tmp_path):
    folder, _ = raw
    csv, silver = str(tmp_path / "zones.csv"), str(tmp_path / "silver")
    write_csv(zones(spark), csv, sep=",")
    assert run_job(spark, f"{folder}/*_tripdata_2023*.parquet", csv, silver) == 4
    table = spark.read.parquet(silver)
    assert table.filter("year = 2023 AND month = 1").count() == 4
    write_file(yellow(spark, yellow_row(VendorID=5)), folder, "yellow_tripdata_2023-05")
    with pytest.raises(ValueError, match="vendor_id"):
        run_job(spark, f"{folder}/*_tripdata_2023*.parquet", csv, silver)
    assert spark.read.parquet(silver).count() == 4


def test_interrupted_swap_is_undone(spark, tmp_path):
    live, retired = str(tmp_path / "t"), str(tmp_path / "t__retired")
    spark.range(3).write.parquet(retired)
    assert restore(spark, live, retired) and spark.read.parquet(live).count() == 3
    assert not restore(spark, live, retired)


def test_checked_write_replaces_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    context = Context(stem="yellow")
    names = ["snake_names", "canonical_names", "tag_origin", "cast_types"]
    for day in (1, 2):
        row = yellow_row(tpep_pickup_datetime=NOON, tpep_dropoff_datetime=NOON + timedelta(minutes=day))
        trips = add_calendar(run_steps(yellow(spark, row), context, names), "pickup_datetime")
        assert write_checked(trips, path, trip_contract()) == 1
    assert spark.read.parquet(path).count() == 1


def test_logged_runs(spark, raw, tmp_path):
    folder, paths = raw
    log_path = str(tmp_path / "log")
    silver = run_logged(spark, paths, zone_lookup=zones(spark), job="etl", log=log_path)
    assert silver.count() == 4 and "_source" not in silver.columns
    log = spark.read.parquet(log_path)
    assert log.count() == 2 + len(paths) * (2 + 2 * len(DEFAULT_STEPS))
    assert invalid_transitions(log).count() == 0
    done = log.filter("job_namespace = 'run_steps' AND event_type = 'COMPLETE'").collect()
    assert {r.job_name.rsplit("/", 1)[1]: r.row_count for r in done} == {
        "green_tripdata_2023-01.parquet": 1, "yellow_tripdata_2023-01.parquet": 2, "yellow_tripdata_2023-02.parquet": 1,
    }
    assert run_tree(log).filter("depth = 2").count() == len(paths) * len(DEFAULT_STEPS)

    bad = write_file(yellow(spark, yellow_row(VendorID=5)), folder, "yellow_tripdata_2023-09")
    with pytest.raises(ValueError):
        run_logged(spark, [*paths, bad], zone_lookup=zones(spark), job="second", log=log_path)
    failed = failures(spark.read.parquet(log_path)).collect()
    assert {r.job_namespace for r in failed} == {"meterline", "run_steps", "step"}
    assert all("vendor_id" in r.error_message and "run_pipeline" in r.stack_trace for r in failed)
