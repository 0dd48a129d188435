"""Raw trip feeds derived from the given tables.

``lineitem`` plays the yellow feed and ``orders`` the green one, with the raw
column names and loose types of real trip files: double and bigint codes,
naive timestamps, optional columns. Values are spread so that every keep rule,
contract check, code list and NULL case is met. ``nation`` and ``region`` play
the zone dimension, which knows only some of the trips' zones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

YELLOW_STEM = "yellow_tripdata_1997-01"
GREEN_STEM = "green_tripdata_1997-01"

YELLOW = [
    """CASE CAST(round(l_tax * 100) AS BIGINT) WHEN 0 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 2 WHEN 5 THEN 200
       ELSE CAST(round(l_tax * 100) AS BIGINT) END AS VendorID""",
    "timestampadd(SECOND, l_partkey * 40 + l_suppkey * 7, l_shipdate) AS tpep_pickup_datetime",
    """timestampadd(MICROSECOND, 1000000 * (l_partkey * 40 + l_suppkey * 7) +
       CASE WHEN l_linenumber = 4 AND l_returnflag = 'R' THEN 500000
            WHEN l_linenumber = 4 AND l_returnflag = 'A' THEN 1000000L * 43200
            WHEN l_linenumber = 3 AND l_returnflag = 'A' THEN 1000000L * 43201
            WHEN l_linenumber = 3 AND l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL
            WHEN l_linenumber = 2 AND l_returnflag = 'R' AND l_quantity > 45 THEN -1000000L * 60
            ELSE 1000000L * 60 * CAST(l_quantity AS BIGINT) END, l_shipdate) AS tpep_dropoff_datetime""",
    """CASE WHEN l_quantity = 13 THEN NULL WHEN l_returnflag = 'N' THEN l_linenumber + CAST(0.7 AS DOUBLE)
       ELSE CAST(l_linenumber AS DOUBLE) END AS passenger_count""",
    """CASE WHEN l_quantity = 17 THEN NULL WHEN l_tax = CAST(0.08 AS DOUBLE) THEN CAST(0 AS DOUBLE)
       ELSE l_quantity * (CAST(0.2 AS DOUBLE) + l_discount * CAST(10 AS DOUBLE)) END AS trip_distance""",
    """CAST(CASE CAST(round(l_discount * 100) AS BIGINT) WHEN 0 THEN 99 WHEN 7 THEN 1 WHEN 8 THEN 5 WHEN 9 THEN NULL
       WHEN 10 THEN 1 ELSE CAST(round(l_discount * 100) AS BIGINT) END AS DOUBLE) AS RatecodeID""",
    """CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN NULL WHEN l_linestatus = 'F' THEN 'Y'
       ELSE 'N' END AS store_and_fwd_flag""",
    "CAST(l_quantity AS BIGINT) AS PULocationID",
    "CAST(round(l_tax * 100) AS BIGINT) * 3 + 1 AS DOLocationID",
    "CASE WHEN l_quantity = 21 THEN NULL ELSE CAST(l_linenumber - 1 AS BIGINT) END AS payment_type",
    """CASE WHEN l_quantity = 23 THEN NULL WHEN l_returnflag = 'R' THEN -l_extendedprice
       ELSE l_extendedprice END AS fare_amount""",
    "l_tax AS extra",
    "l_discount AS tip_amount",
    """CASE WHEN l_quantity = 23 THEN NULL WHEN l_returnflag = 'R' THEN -l_extendedprice
       ELSE l_extendedprice END AS total_amount""",
    "CAST(1.25 AS DOUBLE) AS Airport_fee",
]

GREEN = [
    "CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 6 END AS VendorID",
    "timestampadd(SECOND, o_custkey * 50, o_orderdate) AS lpep_pickup_datetime",
    """timestampadd(SECOND, o_custkey * 50 + 600 * CAST(left(o_orderpriority, 1) AS INT), o_orderdate)
       AS lpep_dropoff_datetime""",
    "CAST(left(o_orderpriority, 1) AS DOUBLE) AS passenger_count",
    "o_totalprice / CAST(100000 AS DOUBLE) AS trip_distance",
    """CAST(CASE WHEN o_orderstatus = 'P' AND left(o_orderpriority, 1) = '3' THEN 99
       ELSE CAST(left(o_orderpriority, 1) AS INT) END AS DOUBLE) AS RatecodeID""",
    "CAST(NULL AS STRING) AS store_and_fwd_flag",
    "CAST(left(o_orderpriority, 1) AS BIGINT) * 6 AS PULocationID",
    "CAST(left(o_orderpriority, 1) AS BIGINT) AS DOLocationID",
    "CAST(left(o_orderpriority, 1) AS DOUBLE) AS payment_type",
    "CASE WHEN left(o_orderpriority, 1) = '3' THEN -o_totalprice ELSE o_totalprice END AS fare_amount",
    "CASE WHEN left(o_orderpriority, 1) = '3' THEN -o_totalprice ELSE o_totalprice END AS total_amount",
    "CAST(0.5 AS DOUBLE) AS mta_tax",
    "CAST(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END AS DOUBLE) AS trip_type",
    "CAST(NULL AS DOUBLE) AS ehail_fee",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def yellow_feed(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(*YELLOW)


def green_feed(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(*GREEN)


def zone_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Zones under raw names and as text, the way a CSV gives them."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        (F.col("n_nationkey") + 1).cast("string").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.when(F.col("r_name") == "ASIA", "N/A").otherwise(F.concat(F.col("r_name"), F.lit(" Zone"))).alias(
            "service_zone"
        ),
    )
