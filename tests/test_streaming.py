import pytest
from pyspark.sql import functions as F

from meterline.plans.steps import Context
from meterline.plans.trips import run_pipeline
from meterline.sources.files import file_table
from meterline.streaming.events import drop_redeliveries, touched_days
from meterline.streaming.ingest import BatchLoader, landing_files, start_ingest
from tests.trips import NOON, green, green_row, write_file, yellow, yellow_row, zones


class Lake:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.landing = root / "landing"
        (self.landing / "sub").mkdir(parents=True)
        self.loader = BatchLoader(spark, zones(spark), f"{root}/silver", f"{root}/dead", Context(), f"{root}/log")

    def run(self, **limits):
        stream = landing_files(self.spark, str(self.landing), **limits)
        query = start_ingest(stream, self.loader, f"{self.root}/checkpoint", every=None)
        query.awaitTermination()
        return query

    def silver(self):
        return self.spark.read.parquet(f"{self.root}/silver")

    def letters(self):
        rows = self.spark.read.parquet(f"{self.root}/dead").collect()
        return {r.source_file.rsplit("/", 1)[1]: r.reason for r in rows}


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def land_good(lake):
    spark = lake.spark
    return [
        write_file(green(spark, green_row()), lake.landing, "green_tripdata_2023-01"),
        write_file(yellow(spark, yellow_row(), yellow_row(DOLocationID=3)), lake.landing, "yellow_tripdata_2023-01"),
        write_file(yellow(spark, yellow_row()), lake.landing / "sub", "yellow_tripdata_2023-02"),
    ]


def test_stream_equals_batch_and_a_rerun_adds_nothing(lake):
    paths = land_good(lake)
    lake.run(max_files=2)
    batch = run_pipeline(lake.spark, paths, zone_lookup=zones(lake.spark))
    streamed = lake.silver().select(*batch.columns)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    assert lake.silver().select("batch_id").distinct().count() == 2
    lake.run(max_files=2)
    assert lake.silver().count() == batch.count()
    write_file(green(lake.spark, green_row(PULocationID=1)), lake.landing, "green_tripdata_2023-02")
    lake.run(max_bytes=1000)
    assert lake.silver().count() == batch.count() + 1


def test_replayed_batch_replaces_itself(lake):
    paths = land_good(lake)
    lake.loader.load(paths, 7)
    lake.loader.load(paths, 7)
    assert lake.silver().count() == 4
    assert set(r.batch_id for r in file_table(lake.spark, f"{lake.root}/silver").collect()) == {7}


def test_bad_files_go_to_the_dead_letter_and_the_rest_is_loaded(lake):
    land_good(lake)
    (lake.landing / "broken.parquet").write_text("not parquet")
    write_file(yellow(lake.spark, yellow_row(VendorID=5)), lake.landing, "yellow_tripdata_2023-05")
    write_file(yellow(lake.spark, yellow_row(passenger_count=9.0)), lake.landing, "yellow_tripdata_2023-06")
    write_file(lake.spark.createDataFrame([(1,)], "other int"), lake.landing, "yellow_tripdata_2023-07")
    lake.run()
    assert lake.letters() == {
        "broken.parquet": "unreadable",
        "yellow_tripdata_2023-05.parquet": "contract",
        "yellow_tripdata_2023-06.parquet": "contract",
        "yellow_tripdata_2023-07.parquet": "failed",
    }
    log = lake.spark.read.parquet(f"{lake.root}/log")
    ends = log.filter("job_namespace = 'run_steps' AND event_type <> 'START'").groupBy("event_type").count()
    assert {r.event_type: r["count"] for r in ends.collect()} == {"COMPLETE": 3, "FAIL": 4}
    assert log.filter("event_type = 'COMPLETE' AND job_namespace = 'run_steps'").agg(F.sum("row_count")).first()[0] == 4
    assert lake.silver().count() == 4


def test_damage_behind_a_good_footer_is_isolated(lake):
    land_good(lake)
    path = write_file(yellow(lake.spark, *[yellow_row(PULocationID=i) for i in range(50)]), lake.landing, "yellow_tripdata_2023-08")
    with open(path, "r+b") as out:
        out.seek(4)
        out.write(b"\xff" * 200)
    lake.run()
    assert lake.letters() == {"yellow_tripdata_2023-08.parquet": "failed"}
    assert lake.silver().count() == 4


def test_letters_disappear_when_the_replayed_batch_is_healthy(lake):
    path = lake.landing / "yellow_tripdata_2023-01.parquet"
    path.write_text("half an upload")
    lake.loader.load([str(path)], 1)
    assert lake.letters() == {path.name: "unreadable"}
    write_file(yellow(lake.spark, yellow_row()), lake.landing, "yellow_tripdata_2023-01")
    lake.loader.load([str(path)], 1)
    assert lake.silver().count() == 1 and not (lake.root / "dead" / "stream_id=direct" / "batch_id=1").exists()


def test_redelivered_events_are_dropped(spark, tmp_path):
    events = spark.range(20).select("id", (F.lit("2024-01-01").cast("timestamp")).alias("ts"))
    for delivery in ("a", "b"):
        events.write.parquet(str(tmp_path / "in" / delivery))
    stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    query = (
        drop_redeliveries(stream, ["id"], "ts").writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.table("once").count() == 20


def test_touched_days(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 10:00:00' ts UNION ALL SELECT timestamp'2024-01-02 10:00:00'")
    assert [str(r.day) for r in touched_days(df, "ts", F.lit("2024-01-01 12:00:00").cast("timestamp")).collect()] == ["2024-01-02"]


def test_a_wrong_schema_alone_in_its_batch_is_a_letter(lake):
    write_file(yellow(lake.spark, yellow_row()).drop("total_amount"), lake.landing, "yellow_tripdata_2023-03")
    lake.run(max_files=1)
    assert lake.letters() == {"yellow_tripdata_2023-03.parquet": "contract"}
    land_good(lake)
    lake.run(max_files=1)
    assert lake.silver().count() == 4


def test_a_shared_fault_stops_the_stream_and_makes_no_letter(lake):
    land_good(lake)
    broken = lake.spark.createDataFrame([("a", "b")], "x string, y string")
    loader = BatchLoader(lake.spark, broken.select(F.raise_error(F.lit("zones")).cast("int").alias("LocationID"), F.col("x").alias("Borough"), F.col("y").alias("Zone"), F.col("y").alias("service_zone")), f"{lake.root}/silver", f"{lake.root}/dead")
    with pytest.raises(Exception, match="zones"):
        loader.load([str(p) for p in lake.landing.glob("*.parquet")], 0)
    assert not (lake.root / "dead").exists()


def test_a_new_checkpoint_keeps_what_is_there(lake):
    paths = land_good(lake)
    lake.loader.load(paths[:1], 0, "first")
    lake.loader.load(paths[1:], 0, "second")
    assert lake.silver().count() == 4


def test_store_keeps_events_without_id_or_time_once(spark, tmp_path):
    from meterline.streaming.events import EventStore

    noon = NOON.replace(tzinfo=None)
    rows = [(1, noon, "a"), (None, noon, "no id"), (2, None, "no time"), (None, None, "neither"), (None, noon, "no id")]
    events = spark.createDataFrame(rows, "id long, ts timestamp, what string")
    store = EventStore(f"{tmp_path}/store", ["id"], "ts")
    for batch_id in (0, 1, 2, 2):
        store(events, batch_id)
    assert sorted(r.what for r in spark.read.parquet(f"{tmp_path}/store").collect()) == ["a", "neither", "no id", "no time"]


def test_only_conditions_make_a_fault_of_a_file(spark, tmp_path):
    from meterline.streaming.ingest import is_file_fault

    assert not is_file_fault(RuntimeError("lost a disk while it said [CAST_OVERFLOW]"))
    whole = write_file(yellow(spark, *[yellow_row()] * 5000), tmp_path, "cut")
    with open(whole, "r+b") as file:  # the footer stays, the pages are spoiled
        file.seek(8)
        file.write(b"\xff" * 400)
    with pytest.raises(Exception) as caught:
        spark.read.parquet(whole).collect()
    assert is_file_fault(caught.value)
