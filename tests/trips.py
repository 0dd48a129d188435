"""Raw trip rows for tests: a good trip, changed one field at a time."""

from datetime import datetime, timedelta

NOON = datetime(2023, 1, 15, 12, 0, 0)

YELLOW = (
    "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count double, trip_distance double, RatecodeID double, store_and_fwd_flag string, "
    "PULocationID bigint, DOLocationID bigint, payment_type bigint, fare_amount double, "
    "total_amount double, Airport_fee double"
)
GREEN = (
    "VendorID bigint, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz, "
    "passenger_count double, trip_distance double, RatecodeID double, store_and_fwd_flag string, "
    "PULocationID bigint, DOLocationID bigint, payment_type double, fare_amount double, "
    "total_amount double, trip_type double, ehail_fee double"
)
ZONES = [("1", "Alpha", "North", "Yellow Zone"), ("2", "N/A", "South", "N/A"), ("3", "Beta", "East", "Boro Zone")]
ZONE_COLUMNS = "LocationID string, Borough string, Zone string, service_zone string"


def yellow_row(**changes):
    row = {
        "VendorID": 1, "tpep_pickup_datetime": NOON, "tpep_dropoff_datetime": NOON + timedelta(minutes=10),
        "passenger_count": 1.0, "trip_distance": 2.0, "RatecodeID": 1.0, "store_and_fwd_flag": "N",
        "PULocationID": 1, "DOLocationID": 2, "payment_type": 1, "fare_amount": 10.0, "total_amount": 12.5,
        "Airport_fee": 0.0,
    }
    return tuple({**row, **changes}.values())


def green_row(**changes):
    row = {
        "VendorID": 2, "lpep_pickup_datetime": NOON, "lpep_dropoff_datetime": NOON + timedelta(minutes=20),
        "passenger_count": 2.0, "trip_distance": 3.0, "RatecodeID": 1.0, "store_and_fwd_flag": "Y",
        "PULocationID": 3, "DOLocationID": 77, "payment_type": 2.0, "fare_amount": 20.0, "total_amount": 22.0,
        "trip_type": 1.0, "ehail_fee": None,
    }
    return tuple({**row, **changes}.values())


def yellow(spark, *rows):
    return spark.createDataFrame(list(rows), YELLOW)


def green(spark, *rows):
    return spark.createDataFrame(list(rows), GREEN)


def zones(spark):
    return spark.createDataFrame(ZONES, ZONE_COLUMNS)


def write_file(df, folder, name):
    """One parquet file of that name, as trip files come."""
    import pyarrow.parquet as pq

    path = f"{folder}/{name}.parquet"
    pq.write_table(df.toArrow(), path)
    return path
