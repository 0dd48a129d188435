"""The same questions in SQL, for an engine other than Spark.

Written from the operators' definitions, not from the Spark code: the derived
feeds are spelled out again, and each query states what its rows must be.
"""

from __future__ import annotations

from checks.catalog import TABLES

YELLOW_RAW = """
SELECT
  CASE CAST(round(l_tax * 100) AS BIGINT) WHEN 0 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 2 WHEN 5 THEN 200
       ELSE CAST(round(l_tax * 100) AS BIGINT) END AS VendorID,
  l_shipdate + to_seconds(l_partkey * 40 + l_suppkey * 7) AS tpep_pickup_datetime,
  CASE WHEN l_linenumber = 4 AND l_returnflag = 'R'
         THEN l_shipdate + to_seconds(l_partkey * 40 + l_suppkey * 7) + to_milliseconds(500)
       WHEN l_linenumber = 4 AND l_returnflag = 'A'
         THEN l_shipdate + to_seconds(l_partkey * 40 + l_suppkey * 7 + 43200)
       WHEN l_linenumber = 3 AND l_returnflag = 'A'
         THEN l_shipdate + to_seconds(l_partkey * 40 + l_suppkey * 7 + 43201)
       WHEN l_linenumber = 3 AND l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL
       WHEN l_linenumber = 2 AND l_returnflag = 'R' AND l_quantity > 45
         THEN l_shipdate + to_seconds(l_partkey * 40 + l_suppkey * 7 - 60)
       ELSE l_shipdate + to_seconds(l_partkey * 40 + l_suppkey * 7 + CAST(l_quantity AS BIGINT) * 60)
  END AS tpep_dropoff_datetime,
  CASE WHEN l_quantity = 13 THEN NULL WHEN l_returnflag = 'N' THEN l_linenumber + CAST(0.7 AS DOUBLE)
       ELSE CAST(l_linenumber AS DOUBLE) END AS passenger_count,
  CASE WHEN l_quantity = 17 THEN NULL WHEN l_tax = CAST(0.08 AS DOUBLE) THEN CAST(0 AS DOUBLE)
       ELSE l_quantity * (CAST(0.2 AS DOUBLE) + l_discount * CAST(10 AS DOUBLE)) END AS trip_distance,
  CAST(CASE CAST(round(l_discount * 100) AS BIGINT) WHEN 0 THEN 99 WHEN 7 THEN 1 WHEN 8 THEN 5
       WHEN 9 THEN NULL WHEN 10 THEN 1 ELSE CAST(round(l_discount * 100) AS BIGINT) END AS DOUBLE) AS RatecodeID,
  CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN NULL WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N'
  END AS store_and_fwd_flag,
  CAST(l_quantity AS BIGINT) AS PULocationID,
  CAST(round(l_tax * 100) AS BIGINT) * 3 + 1 AS DOLocationID,
  CASE WHEN l_quantity = 21 THEN NULL ELSE CAST(l_linenumber - 1 AS BIGINT) END AS payment_type,
  CASE WHEN l_quantity = 23 THEN NULL WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice
  END AS fare_amount,
  l_tax AS extra,
  l_discount AS tip_amount,
  CASE WHEN l_quantity = 23 THEN NULL WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice
  END AS total_amount,
  CAST(1.25 AS DOUBLE) AS Airport_fee
FROM lineitem
"""

GREEN_RAW = """
SELECT
  CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 6 END AS VendorID,
  o_orderdate + to_seconds(o_custkey * 50) AS lpep_pickup_datetime,
  o_orderdate + to_seconds(o_custkey * 50 + 600 * digit) AS lpep_dropoff_datetime,
  CAST(digit AS DOUBLE) AS passenger_count,
  o_totalprice / CAST(100000 AS DOUBLE) AS trip_distance,
  CAST(CASE WHEN o_orderstatus = 'P' AND digit = 3 THEN 99 ELSE digit END AS DOUBLE) AS RatecodeID,
  CAST(NULL AS VARCHAR) AS store_and_fwd_flag,
  digit * 6 AS PULocationID,
  digit AS DOLocationID,
  CAST(digit AS DOUBLE) AS payment_type,
  CASE WHEN digit = 3 THEN -o_totalprice ELSE o_totalprice END AS fare_amount,
  CASE WHEN digit = 3 THEN -o_totalprice ELSE o_totalprice END AS total_amount,
  CAST(0.5 AS DOUBLE) AS mta_tax,
  CAST(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END AS DOUBLE) AS trip_type,
  CAST(NULL AS DOUBLE) AS ehail_fee
FROM (SELECT *, CAST(left(o_orderpriority, 1) AS BIGINT) AS digit FROM orders)
"""

ZONES = """
SELECT CAST(n_nationkey + 1 AS INTEGER) AS location_id, r_name AS borough, n_name AS zone,
       CASE WHEN r_name = 'ASIA' THEN 'N/A' ELSE r_name || ' Zone' END AS service_zone
FROM nation JOIN region ON n_regionkey = r_regionkey
"""

# DuckDB rounds when it casts to an integer, so the fraction is cut first.
YELLOW = """
SELECT
  TRY_CAST(VendorID AS TINYINT) AS vendor_id,
  tpep_pickup_datetime AS pickup_datetime,
  tpep_dropoff_datetime AS dropoff_datetime,
  TRY_CAST(trunc(passenger_count) AS TINYINT) AS passenger_count,
  trip_distance AS trip_distance_mi,
  TRY_CAST(trunc(RatecodeID) AS TINYINT) AS ratecode_id,
  store_and_fwd_flag AS store_and_foward,
  TRY_CAST(PULocationID AS SMALLINT) AS pickup_location_id,
  TRY_CAST(DOLocationID AS SMALLINT) AS dropoff_location_id,
  TRY_CAST(payment_type AS TINYINT) AS payment_type_id,
  fare_amount, extra, tip_amount, total_amount, Airport_fee AS airport_fee,
  'TPEP' AS origin, CAST(1 AS TINYINT) AS origin_id
FROM yellow_raw
"""

GREEN = """
SELECT
  TRY_CAST(VendorID AS TINYINT) AS vendor_id,
  lpep_pickup_datetime AS pickup_datetime,
  lpep_dropoff_datetime AS dropoff_datetime,
  TRY_CAST(trunc(passenger_count) AS TINYINT) AS passenger_count,
  trip_distance AS trip_distance_mi,
  TRY_CAST(trunc(RatecodeID) AS TINYINT) AS ratecode_id,
  store_and_fwd_flag AS store_and_foward,
  TRY_CAST(PULocationID AS SMALLINT) AS pickup_location_id,
  TRY_CAST(DOLocationID AS SMALLINT) AS dropoff_location_id,
  TRY_CAST(trunc(payment_type) AS TINYINT) AS payment_type_id,
  fare_amount, total_amount, mta_tax, TRY_CAST(trunc(trip_type) AS TINYINT) AS trip_type_id, ehail_fee,
  'LPEP' AS origin, CAST(2 AS TINYINT) AS origin_id
FROM green_raw
"""


def _decode(column: str, codes: dict[int, str]) -> str:
    arms = " ".join(f"WHEN {code} THEN '{text}'" for code, text in codes.items())
    return f"CASE {column} {arms} END"


# Code lists.
VENDOR = _decode("vendor_id", {1: "Creative Mobile Technologies, LLC", 2: "Curb Mobility, LLC", 6: "Myle Technologies Inc", 7: "Helix"})
RATE = _decode(
    "ratecode_id",
    {1: "Standard rate", 2: "JFK", 3: "Newark", 4: "Nassau or Westchester", 5: "Negotiated fare", 6: "Group ride", 99: "Null/unknown"},
)
PAYMENT = _decode(
    "payment_type_id",
    {0: "Flex Fare trip", 1: "Credit card", 2: "Cash", 3: "No charge", 4: "Dispute", 5: "Unknown", 6: "Voided trip"},
)
TRIP = _decode("trip_type_id", {1: "Street-hail", 2: "Dispatch"})

SECONDS = "date_diff('second', pickup_datetime, dropoff_datetime)"
MPH = f"(trip_distance_mi / nullif({SECONDS}, 0) * 3600)"

RULES = {
    "passengers_in_range": "passenger_count BETWEEN 0 AND 6",
    "rate_known": "ratecode_id <> 99",
    "duration_possible": f"(dropoff_datetime > pickup_datetime AND {SECONDS} <= 43200)",
    "no_charge_without_fare": "NOT (payment_type_id = 3 AND fare_amount > 0)",
    "zero_miles_negotiated": "NOT (ratecode_id <> 5 AND trip_distance_mi = 0 AND fare_amount > 0)",
    "speed_possible": f"NOT ({MPH} > 70)",
}
KEEP = " AND ".join(f"({rule})" for rule in RULES.values())
BROKEN = "concat_ws(',', {})".format(
    ", ".join(f"CASE WHEN NOT coalesce({rule}, false) THEN '{name}' END" for name, rule in RULES.items())
)
LISTED = {
    "vendor_listed": "vendor_id IN (1, 2, 6, 7)",
    "rate_listed": "ratecode_id IN (1, 2, 3, 4, 5, 6)",
    "payment_listed": "payment_type_id BETWEEN 0 AND 6",
    "fare_present": "fare_amount IS NOT NULL",
    "total_present": "total_amount IS NOT NULL",
}
ALL_BROKEN = "concat_ws(',', {})".format(
    ", ".join(f"CASE WHEN NOT coalesce({rule}, false) THEN '{name}' END" for name, rule in {**RULES, **LISTED}.items())
)
CONTRACT_PASS = (
    "vendor_id IN (1, 2, 6, 7) AND ratecode_id IN (1, 2, 3, 4, 5, 6) AND payment_type_id BETWEEN 0 AND 6 "
    "AND fare_amount IS NOT NULL AND total_amount IS NOT NULL"
)

UNLISTED_VENDOR_PASS = " AND ".join(rule for name, rule in LISTED.items() if name != "vendor_listed")

ENDS = """
  p.borough AS pickup_borough, p.zone AS pickup_zone, p.service_zone AS pickup_service_zone,
  d.borough AS dropoff_borough, d.zone AS dropoff_zone, d.service_zone AS dropoff_service_zone
"""
ZONE_JOIN = """
  LEFT JOIN zones p ON t.pickup_location_id = p.location_id
  LEFT JOIN zones d ON t.dropoff_location_id = d.location_id
"""

PRELUDE = f"""
WITH yellow_raw AS ({YELLOW_RAW}), green_raw AS ({GREEN_RAW}), zones AS ({ZONES}),
yellow AS ({YELLOW}), green AS ({GREEN}),
trips AS (SELECT * FROM yellow UNION ALL BY NAME SELECT * FROM green),
decoded AS (SELECT *, {VENDOR} AS vendor, {RATE} AS ratecode, {PAYMENT} AS payment_type, {TRIP} AS trip_type FROM trips),
cleaned AS (
  SELECT * EXCLUDE (ehail_fee) FROM (
    SELECT DISTINCT * FROM yellow WHERE {KEEP} UNION ALL BY NAME SELECT DISTINCT * FROM green WHERE {KEEP})),
silver AS (
  SELECT t.*, {VENDOR} AS vendor, {RATE} AS ratecode, {PAYMENT} AS payment_type, {TRIP} AS trip_type, {ENDS}
  FROM cleaned t {ZONE_JOIN})
"""

ORDER_LOG = """,
outcomes AS (
  SELECT 'order-' || o_orderkey AS source, o_orderdate AS started_at,
         o_orderdate + INTERVAL 10 MINUTE AS finished_at,
         CAST(coalesce(n, 0) AS BIGINT) AS row_count, CAST(coalesce(n, 0) * 100 AS BIGINT) AS size_bytes,
         o_orderstatus = 'P' AS failed
  FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey),
runs AS (
  SELECT md5('meterline|orders') AS run_id, CAST(NULL AS VARCHAR) AS parent_run_id, 'meterline' AS job_namespace,
         'orders' AS job_name, 'orders' AS input_name, min(started_at) AS started_at, max(finished_at) AS finished_at,
         CAST(sum(row_count) AS BIGINT) AS row_count, CAST(sum(size_bytes) AS BIGINT) AS size_bytes,
         false AS failed, 1 AS seq
  FROM outcomes
  UNION ALL
  SELECT md5('meterline|orders|' || source), md5('meterline|orders'), 'run_steps', source, source,
         started_at, finished_at, row_count, size_bytes, failed, 1 FROM outcomes
  UNION ALL
  SELECT md5('meterline|orders|' || source || '|' || step), md5('meterline|orders|' || source), 'step', step, source,
         started_at, finished_at, row_count, size_bytes, failed AND step = 'clean', position * 2 + 3
  FROM outcomes, (VALUES ('conform', 0), ('clean', 1), ('validate', 2)) AS s(step, position)
  WHERE NOT (failed AND step = 'validate')),
log AS (
  SELECT 'START' AS event_type, started_at AS event_time, CAST(seq AS BIGINT) AS seq, run_id, parent_run_id,
         job_namespace, job_name, 'meterline' AS producer, CAST(NULL AS BIGINT) AS row_count,
         CAST(NULL AS BIGINT) AS size_bytes, CAST(NULL AS VARCHAR) AS error_message,
         CAST(NULL AS VARCHAR) AS stack_trace, input_name
  FROM runs
  UNION ALL
  SELECT CASE WHEN failed THEN 'FAIL' ELSE 'COMPLETE' END, finished_at, seq + 1, run_id, parent_run_id,
         job_namespace, job_name, 'meterline', CASE WHEN NOT failed THEN row_count END,
         CASE WHEN NOT failed THEN size_bytes END, CASE WHEN failed THEN 'pending' END,
         CASE WHEN failed THEN 'pending in clean' END, input_name
  FROM runs)
"""

TYPES = """
CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
  WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>'
  WHEN 'TINYINT' THEN 'tinyint' WHEN 'SMALLINT' THEN 'smallint' END
"""


def _values(relation: str) -> str:
    """One row per column of ``relation`` with its number of values."""
    return (
        f"(UNPIVOT (SELECT COUNT(COLUMNS(*)) FROM {relation}) ON COLUMNS(*) "
        "INTO NAME column_name VALUE n_values)"
    )


def _month(taxi: str, month: int, relation: str) -> str:
    return f"""
SELECT '{taxi}' AS taxi, CAST(1997 AS INTEGER) AS year, CAST({month} AS INTEGER) AS month, column_name,
       CAST(position AS INTEGER) AS position, {TYPES} AS type, (SELECT count(*) FROM {relation}) AS n_rows, n_values
FROM {_values(relation)} JOIN (
  SELECT column_name, column_type, row_number() OVER () AS position FROM (DESCRIBE SELECT * FROM {relation})) USING (column_name)"""


TWO_MONTHS = """,
yellow_feb AS (SELECT * EXCLUDE (tip_amount), CAST(NULL AS DOUBLE) AS congestion_surcharge FROM yellow_raw WHERE PULocationID <= 25),
green_feb AS (SELECT * FROM green_raw WHERE PULocationID > 6),
months AS ({})
""".format(
    " UNION ALL ".join(
        _month(*x) for x in [("yellow", 1, "yellow_raw"), ("green", 1, "green_raw"), ("yellow", 2, "yellow_feb"), ("green", 2, "green_feb")]
    )
)


def _counts(source: str, checks: list[tuple[str, str, str]], extra: str = "") -> str:
    """One row per (rule, column, condition for a failure)."""
    return " UNION ALL ".join(
        f"SELECT {extra}'{rule}' AS rule, '{column}' AS column_name, "
        f"CAST(count(*) FILTER ({bad}) AS BIGINT) AS failures FROM {source}"
        for rule, column, bad in checks
    )


CONTRACT = [
    ("not_null", "vendor_id", "vendor_id IS NULL"),
    ("in_list", "vendor_id", "vendor_id NOT IN (1, 2, 6, 7)"),
    ("not_null", "pickup_datetime", "pickup_datetime IS NULL"),
    ("not_null", "dropoff_datetime", "dropoff_datetime IS NULL"),
    ("not_null", "passenger_count", "passenger_count IS NULL"),
    ("at_least", "passenger_count", "passenger_count < 0"),
    ("at_most", "passenger_count", "passenger_count > 6"),
    ("not_null", "trip_distance_mi", "trip_distance_mi IS NULL"),
    ("at_least", "trip_distance_mi", "trip_distance_mi < 0"),
    ("not_null", "ratecode_id", "ratecode_id IS NULL"),
    ("in_list", "ratecode_id", "ratecode_id NOT IN (1, 2, 3, 4, 5, 6, 99)"),
    ("not_null", "fare_amount", "fare_amount IS NULL"),
    ("not_null", "payment_type_id", "payment_type_id IS NULL"),
    ("in_list", "payment_type_id", "payment_type_id NOT BETWEEN 0 AND 6"),
    ("not_null", "total_amount", "total_amount IS NULL"),
    ("valid_trip_duration", "*", f"NOT coalesce({RULES['duration_possible']}, false)"),
    ("valid_no_charge_fare", "*", "payment_type_id = 3 AND fare_amount > 0"),
    ("valid_negotiated_fare", "*", "ratecode_id <> 5 AND trip_distance_mi = 0 AND fare_amount > 0"),
]

YELLOW_COLUMNS = (
    "vendor_id pickup_datetime dropoff_datetime passenger_count trip_distance_mi ratecode_id store_and_foward "
    "pickup_location_id dropoff_location_id payment_type_id fare_amount extra tip_amount total_amount airport_fee "
    "origin origin_id"
).split()

EMPTY = (
    " UNION ALL SELECT 'not_empty', '*', CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) FROM yellow"
    + "".join(
        f" UNION ALL SELECT 'has_values', '{c}', "
        f"CAST(CASE WHEN count(*) > 0 AND count({c}) = 0 THEN 1 ELSE 0 END AS BIGINT) FROM yellow"
        for c in YELLOW_COLUMNS
    )
)


def _mean(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18, 2))) AS DOUBLE) / count({column})"


def _profile(relation: str) -> str:
    return f"""
SELECT u.column_name, CAST(u.n_values AS BIGINT) + CAST(v.n_values < c.n AS BIGINT) AS n_unique, c.n AS n_rows,
       (CAST(u.n_values AS BIGINT) + CAST(v.n_values < c.n AS BIGINT)) / CAST(c.n AS DOUBLE) AS unique_ratio
FROM (UNPIVOT (SELECT COUNT(DISTINCT COLUMNS(*)) FROM {relation}) ON COLUMNS(*) INTO NAME column_name VALUE n_values) u
JOIN {_values(relation)} v USING (column_name), (SELECT count(*) AS n FROM {relation}) c
"""


def _dictionary_of(name: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, d.column_name, CAST(d.position AS INTEGER) AS position, {TYPES} AS type, n_values "
        f"FROM (SELECT column_name, column_type, row_number() OVER () AS position FROM (DESCRIBE {name})) d "
        f"JOIN {_values(name)} USING (column_name)"
    )


STAR_ENDS = "pickup_location_id AS location_id, pickup_borough AS borough, pickup_zone AS zone, pickup_service_zone AS service_zone"
STAR_TABLES = {
    "fact": "SELECT * FROM silver",
    "ratecode_id": "SELECT DISTINCT ratecode_id, ratecode FROM silver WHERE ratecode_id IS NOT NULL",
    "vendor_id": "SELECT DISTINCT vendor_id, vendor FROM silver WHERE vendor_id IS NOT NULL",
    "payment_type_id": "SELECT DISTINCT payment_type_id, payment_type FROM silver WHERE payment_type_id IS NOT NULL",
    "trip_type_id": "SELECT DISTINCT trip_type_id, trip_type FROM silver WHERE trip_type_id IS NOT NULL",
    "origin_id": "SELECT DISTINCT origin_id, origin FROM silver",
    "zone": f"SELECT {STAR_ENDS} FROM silver WHERE pickup_location_id IS NOT NULL UNION "
    f"SELECT {STAR_ENDS.replace('pickup_', 'dropoff_')} FROM silver WHERE dropoff_location_id IS NOT NULL",
}

WITH_TRIPS = {
    "conform_union": "SELECT * FROM decoded",
    "union_relaxed": """
SELECT CAST(payment_type AS INTEGER) AS payment, count(*) AS n_rows, max(passenger_count) AS max_passengers
FROM (SELECT CAST(payment_type AS DOUBLE) AS payment_type, passenger_count FROM yellow_raw
      UNION ALL SELECT payment_type, passenger_count FROM green_raw) GROUP BY 1""",
    "decode_codes": """
SELECT vendor, ratecode, payment_type, count(*) AS n_rows FROM decoded WHERE origin_id = 1 GROUP BY ALL""",
    "decode_by_codes_table": """
SELECT vendor, ratecode, payment_type, trip_type, count(*) AS n_rows FROM decoded WHERE origin_id = 2 GROUP BY ALL""",
    "column_metadata": f"SELECT column_name, true AS has_description, n_values FROM {_values('silver')}",
    "enrich_roles": f"""
SELECT vendor_id, pickup_datetime, fare_amount, pickup_location_id, dropoff_location_id, {ENDS}
FROM yellow t {ZONE_JOIN}""",
    "enrich_inner": f"""
SELECT vendor_id, pickup_datetime, fare_amount, pickup_location_id, dropoff_location_id, {ENDS}
FROM yellow t {ZONE_JOIN.replace('LEFT JOIN', 'JOIN')}""",
    "fk_orphans": """
SELECT pickup_location_id, count(*) AS n_rows FROM yellow
WHERE pickup_location_id IS NOT NULL AND pickup_location_id NOT IN (SELECT location_id FROM zones) GROUP BY 1""",
    "star_split_sizes": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM ({sql})" for name, sql in STAR_TABLES.items()
    ),
    "star_rejoined": "SELECT * FROM silver",
    "clean_rules": f"SELECT DISTINCT * FROM yellow WHERE {KEEP}",
    "clean_exact_duration": f"""
SELECT DISTINCT * FROM yellow
WHERE {KEEP} AND epoch_us(dropoff_datetime) - epoch_us(pickup_datetime) <= 43200000000""",
    "trip_speeds": f"""
SELECT ratecode_id, max({MPH}) AS max_mph, count({MPH}) AS n_with_speed,
       CAST(sum({SECONDS}) AS BIGINT) AS sum_seconds FROM yellow GROUP BY 1""",
    "quarantine": f"SELECT {BROKEN} AS broken, count(*) AS n_rows FROM (SELECT DISTINCT * FROM yellow) GROUP BY 1",
    "reject_rules": " UNION ALL ".join(
        f"SELECT '{name}' AS rule, CAST(count(*) FILTER (NOT coalesce({rule}, false)) AS BIGINT) AS rejected_rows "
        "FROM (SELECT DISTINCT * FROM yellow)"
        for name, rule in RULES.items()
    ),
    "contract_violations": _counts(
        "yellow", [*CONTRACT, ("tip_below_fare", "*", "NOT (tip_amount <= abs(fare_amount))")]
    )
    + EMPTY,
    "contract_by_origin": f"""
SELECT * FROM ({_counts("trips GROUP BY origin", CONTRACT, "origin, ")}) WHERE failures > 0""",
    "null_columns": f"""
SELECT column_name, n_values, n_values = 0 AS all_null FROM {_values('green')}""",
    "null_columns_pruned": "SELECT * EXCLUDE (store_and_foward, ehail_fee) FROM green",
    "silver_trips": "SELECT * FROM silver",
    "silver_from_files": f"SELECT DISTINCT * FROM silver WHERE {CONTRACT_PASS}",
    "csv_roundtrip": "SELECT * FROM zones",
    "avg_by_month": f"""
SELECT CAST(month(pickup_datetime) AS INTEGER) AS month, {_mean('total_amount')} AS avg_total_amount FROM silver
WHERE origin_id = 1 AND year(pickup_datetime) = 1997 AND month(pickup_datetime) BETWEEN 1 AND 5 AND total_amount >= 0
GROUP BY 1""",
    "avg_by_hour": f"""
SELECT CAST(hour(pickup_datetime) AS INTEGER) AS hour, {_mean('passenger_count')} AS avg_passenger_count FROM silver
WHERE year(pickup_datetime) = 1997 AND month(pickup_datetime) = 5 AND total_amount >= 0 GROUP BY 1""",
    "gold_sql": f"""
SELECT CAST(month(pickup_datetime) AS INTEGER) AS month, origin, {_mean('total_amount')} AS avg_total_amount
FROM silver WHERE year(pickup_datetime) = 1997 AND total_amount >= 0 GROUP BY ALL""",
    "column_profile_trips": _profile("yellow"),
    "stratified_sample": """
SELECT store_and_foward, payment_type_id, pickup_datetime, dropoff_datetime, fare_amount, trip_distance_mi,
       vendor_id, origin_id
FROM silver
QUALIFY row_number() OVER (
  PARTITION BY store_and_foward, payment_type_id
  ORDER BY pickup_datetime NULLS FIRST, dropoff_datetime NULLS FIRST, fare_amount NULLS FIRST,
           trip_distance_mi NULLS FIRST, vendor_id NULLS FIRST, origin_id NULLS FIRST) = 1""",
    "durations": f"""
SELECT vendor_id, CAST(sum({SECONDS}) AS BIGINT) AS sum_seconds, min({SECONDS}) AS min_seconds,
       max(epoch_us(dropoff_datetime) - epoch_us(pickup_datetime)) / CAST(1000000 AS DOUBLE) AS max_duration
FROM yellow GROUP BY 1""",
    "group_nulls": "SELECT payment_type_id, store_and_foward, count(*) AS n_rows FROM yellow GROUP BY ALL",
    "calendar_counts": """
SELECT CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month,
       CAST(hour(pickup_datetime) AS INTEGER) AS hour, count(*) AS n_trips
FROM yellow WHERE month(pickup_datetime) BETWEEN 1 AND 6 GROUP BY ALL""",
    "schema_diff": f"""
SELECT CAST(1997 AS INTEGER) AS year, CAST(1 AS INTEGER) AS month, column_name,
       string_agg(kind, ',' ORDER BY kind) AS kinds, count(*) = 2 AS is_common, CAST(sum(n_values) AS BIGINT) AS n_values
FROM (SELECT 'yellow' AS kind, * FROM {_values('yellow_raw')} UNION ALL SELECT 'green', * FROM {_values('green_raw')})
GROUP BY column_name""",
    "schema_diff_counts": f"""
SELECT CAST(1997 AS INTEGER) AS year, CAST(1 AS INTEGER) AS month, count(*) FILTER (n = 2) AS n_common,
       count(*) FILTER (n = 1) AS n_single, count(*) AS n_columns
FROM (SELECT column_name, count(*) AS n
      FROM (SELECT * FROM {_values('yellow_raw')} UNION ALL SELECT * FROM {_values('green_raw')})
      WHERE n_values > 0 GROUP BY 1)""",
    "schema_from_files": f"{TWO_MONTHS} SELECT * FROM months",
    "columns_of_one_kind": f"""{TWO_MONTHS}
SELECT year, month, any_value(taxi) AS only_in, count(*) AS n_columns, string_agg(column_name, ',' ORDER BY column_name) AS columns
FROM (SELECT year, month, column_name, min(taxi) AS taxi FROM months GROUP BY ALL HAVING count(*) = 1) GROUP BY year, month, taxi""",
    "empty_columns_of_files": f"""{TWO_MONTHS}
SELECT column_name FROM months GROUP BY 1 HAVING sum(n_values) = 0""",
    "dictionary_gaps": f"""
SELECT CASE column_name WHEN 'PULocationID' THEN 'pu_location_id' ELSE
       CASE column_name WHEN 'DOLocationID' THEN 'do_location_id' ELSE column_name END END AS column_name, n_values
FROM {_values('yellow_raw')}
WHERE column_name IN ('tpep_pickup_datetime', 'tpep_dropoff_datetime', 'trip_distance', 'store_and_fwd_flag',
                      'PULocationID', 'DOLocationID')""",
    "duplicate_zone_keys": "SELECT service_zone, count(*) AS n_rows FROM zones GROUP BY 1 HAVING count(*) > 1",
    "dataset_facets": f"""
SELECT 'meterline' AS namespace, 'silver_trips' AS dataset, 'silver' AS source_uri, 'parquet' AS file_format,
       'lake team' AS owner, 'OVERWRITE' AS lifecycle_change, column_name,
       CAST(row_number() OVER (ORDER BY column_name = 'trip_type' OR column_name = 'trip_type_id'
                               OR column_name = 'mta_tax', column_name) AS INTEGER) AS position,
       CASE {TYPES} WHEN 'timestamp_ntz' THEN 'timestamp' ELSE {TYPES} END AS type, n_values
FROM {_values('silver')} JOIN (SELECT column_name, column_type FROM (DESCRIBE SELECT * FROM silver)) USING (column_name)""",
    "column_lineage": f"""
SELECT output_column, string_agg(column_name, ',' ORDER BY column_name) AS input_columns,
       CAST(sum(n_values) AS BIGINT) AS n_values, 'canonical_names' AS step
FROM (SELECT column_name, n_values, CASE column_name
        WHEN 'lpep_pickup_datetime' THEN 'pickup_datetime' WHEN 'tpep_pickup_datetime' THEN 'pickup_datetime'
        WHEN 'lpep_dropoff_datetime' THEN 'dropoff_datetime' WHEN 'tpep_dropoff_datetime' THEN 'dropoff_datetime'
        WHEN 'store_and_fwd_flag' THEN 'store_and_foward' WHEN 'pu_location_id' THEN 'pickup_location_id'
        WHEN 'do_location_id' THEN 'dropoff_location_id' WHEN 'trip_distance' THEN 'trip_distance_mi'
        WHEN 'payment_type' THEN 'payment_type_id' WHEN 'trip_type' THEN 'trip_type_id'
        ELSE column_name END AS output_column
      FROM (SELECT CASE column_name WHEN 'VendorID' THEN 'vendor_id' WHEN 'RatecodeID' THEN 'ratecode_id'
                     WHEN 'PULocationID' THEN 'pu_location_id' WHEN 'DOLocationID' THEN 'do_location_id'
                     WHEN 'Airport_fee' THEN 'airport_fee' ELSE column_name END AS column_name,
                   sum(n_values) AS n_values
            FROM (SELECT * FROM {_values('yellow_raw')} UNION ALL SELECT * FROM {_values('green_raw')}) GROUP BY 1))
GROUP BY output_column""",
    "ingest_stream": f"""
SELECT origin, CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month,
       count(*) AS n_trips FROM (SELECT DISTINCT * FROM silver WHERE {CONTRACT_PASS}) GROUP BY ALL""",
    "quarantine_rows": f"""
SELECT CASE WHEN broken = '' THEN 'accepted' ELSE 'rejected' END AS verdict, origin, broken,
       CAST(month(pickup_datetime) AS INTEGER) AS month, count(*) AS n_rows
FROM (SELECT pickup_datetime, origin, {ALL_BROKEN} AS broken FROM (
  SELECT DISTINCT * FROM yellow UNION ALL BY NAME SELECT DISTINCT * FROM green))
GROUP BY ALL""",
    "ingest_log": f"""
SELECT CASE origin_id WHEN 1 THEN 'yellow' ELSE 'green' END AS kind, count(*) AS n_trips, true AS sizes_agree
FROM (SELECT DISTINCT * FROM silver WHERE {CONTRACT_PASS}) GROUP BY 1""",
    "published_sources": f"""
SELECT CASE origin_id WHEN 1 THEN 'yellow' ELSE 'green' END AS kind,
       CASE WHEN {ALL_BROKEN} = '' THEN 'accepted' ELSE 'rejected' END AS verdict, count(*) AS n_rows
FROM (SELECT DISTINCT * FROM yellow UNION ALL BY NAME SELECT DISTINCT * FROM green) GROUP BY ALL""",
    "file_contract": f"""
SELECT 'yellow' AS kind, 'in_list' AS rule, 'vendor_id' AS column_name, count(*) AS n_rows
FROM (SELECT DISTINCT * REPLACE (8 AS vendor_id) FROM yellow WHERE {KEEP} AND {UNLISTED_VENDOR_PASS})
UNION ALL SELECT 'green', 'published', '*', count(*) FROM (SELECT DISTINCT * FROM green WHERE {KEEP} AND {UNLISTED_VENDOR_PASS})""",
    "named_steps": f"""
SELECT vendor_id, count(*) AS n_trips, max({SECONDS}) AS longest FROM (SELECT DISTINCT * FROM green WHERE {KEEP}) GROUP BY 1""",
    "zone_dictionary": f"""
SELECT column_name, CASE column_name WHEN 'location_id' THEN 'int' ELSE 'string' END AS type, true AS described, n_values
FROM {_values('zones')}""",
    "bad_file": f"""
SELECT 'loaded' AS outcome, origin AS name, NULL AS each_once, count(*) AS n_trips
FROM (SELECT DISTINCT * FROM silver WHERE {CONTRACT_PASS} AND origin_id = 2) GROUP BY ALL
UNION ALL SELECT 'contract', 'yellow', true, NULL UNION ALL SELECT 'unreadable', 'broken', true, NULL""",
    "broken_rule_names": f"""
SELECT pickup_datetime, fare_amount, ratecode_id, payment_type_id, {BROKEN} AS broken FROM green""",
}

WITH_LOG = {
    "run_log": "SELECT * FROM log",
    "run_failures": """
SELECT job_namespace, error_message, count(*) AS n_runs FROM log WHERE event_type = 'FAIL' GROUP BY ALL""",
    "run_log_validity": """
SELECT 'COMPLETE' AS previous_state, 'RUNNING' AS event_type, count(*) AS n_events
FROM log WHERE job_namespace = 'run_steps' AND event_type = 'COMPLETE'""",
}

# The orders' schema at four times, a week apart: 1 lacks the priority, 2 and 3 have another price, 3 a year.
HISTORY = """
WITH times AS (SELECT n, t0 + n * INTERVAL 7 DAY AS t FROM (SELECT min(o_orderdate) AS t0 FROM orders), (SELECT unnest(range(4)) AS n)),
runs(column_name, type, a, b) AS (VALUES
  ('o_orderkey', 'bigint', 0, NULL), ('o_custkey', 'bigint', 0, NULL), ('o_orderstatus', 'string', 0, NULL),
  ('o_orderdate', 'timestamp_ntz', 0, NULL), ('o_totalprice', 'double', 0, 2), ('o_totalprice', 'decimal(18,2)', 2, NULL),
  ('o_orderpriority', 'string', 0, 1), ('o_orderpriority', 'string', 2, NULL), ('year', 'int', 3, NULL)),
history AS (
  SELECT column_name, type, f.t AS valid_from, u.t AS valid_to,
    min(f.t) OVER (PARTITION BY column_name) AS first_seen, (SELECT max(t) FROM times) AS last_seen
  FROM runs JOIN times f ON f.n = runs.a LEFT JOIN times u ON u.n = runs.b)
"""

# Silver columns of a yellow trip: how they come about, and the columns of line items and zones behind them.
YELLOW_ORIGINS = [
    ("vendor_id", "derived", "l_tax"), ("vendor", "derived", "l_tax"),
    ("pickup_datetime", "derived", "l_partkey l_suppkey l_shipdate"),
    ("dropoff_datetime", "derived", "l_partkey l_suppkey l_shipdate l_linenumber l_returnflag l_linestatus l_quantity"),
    ("passenger_count", "derived", "l_quantity l_returnflag l_linenumber"),
    ("trip_distance_mi", "derived", "l_quantity l_tax l_discount"),
    ("ratecode_id", "derived", "l_discount"), ("ratecode", "derived", "l_discount"),
    ("store_and_foward", "derived", "l_returnflag l_linestatus"),
    ("pickup_location_id", "derived", "l_quantity"), ("dropoff_location_id", "derived", "l_tax"),
    ("payment_type_id", "derived", "l_quantity l_linenumber"), ("payment_type", "derived", "l_quantity l_linenumber"),
    ("fare_amount", "derived", "l_quantity l_returnflag l_extendedprice"), ("total_amount", "derived", "l_quantity l_returnflag l_extendedprice"),
    ("extra", "copied", "l_tax"), ("tip_amount", "copied", "l_discount"), ("airport_fee", "constant", ""),
    ("origin", "constant", ""), ("origin_id", "constant", ""),
    *[(f"{role}_{text}", kind, column) for role in ("pickup", "dropoff") for text, kind, column in (("borough", "copied", "r_name"), ("zone", "copied", "n_name"), ("service_zone", "derived", "r_name"))],
]
_TABLE_OF = {"l": ("trips", "lineitem"), "r": ("region", "region"), "n": ("nation", "nation")}


def _origin_rows() -> str:
    rows = []
    for output, kind, columns in YELLOW_ORIGINS:
        for column in columns.split() or [""]:
            dataset, relation = _TABLE_OF.get(column[:1], (None, None))
            known = f"'{dataset}', '{column}', '{kind}', (SELECT count({column}) FROM {relation})" if dataset else f"NULL, NULL, '{kind}', NULL"
            rows.append(f"SELECT '{output}' AS output_column, {known}")
    return rows[0].replace("'trips', 'l_tax', 'derived', (SELECT count(l_tax) FROM lineitem)", "'trips' AS dataset, 'l_tax' AS input_column, 'derived' AS kind, (SELECT count(l_tax) FROM lineitem) AS n_values") + "".join(f" UNION ALL {row}" for row in rows[1:])


LINEAGE = _origin_rows()

PLAIN = {
    "snake_names": """
SELECT p_partkey, raw_name,
       lower(regexp_replace(regexp_replace(raw_name, '([A-Z])([A-Z][a-z])', '\\1_\\2', 'g'),
                            '([a-z0-9])([A-Z])', '\\1_\\2', 'g')) AS snake_name
FROM (SELECT p_partkey, replace(p_brand, '#', '') || p_type || 'NameID' AS raw_name FROM part)""",
    "fk_orphans_documents": """
SELECT doc_id, count(*) AS n_rows FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1""",
    "dedup_per_file": """
WITH once AS (SELECT event_type, count(*) AS n_rows FROM (SELECT DISTINCT * FROM events) GROUP BY 1)
SELECT 'first' AS source, * FROM once UNION ALL SELECT 'second', * FROM once UNION ALL SELECT NULL, * FROM once""",
    "dedup_by_digest": """
SELECT l_returnflag, l_linestatus, count(*) AS n_rows, count(l_tax) AS n_taxed
FROM (SELECT * FROM lineitem UNION
      SELECT * REPLACE (CASE WHEN l_returnflag <> 'R' THEN l_tax END AS l_tax) FROM lineitem WHERE l_suppkey % 3 = 0)
GROUP BY ALL""",
    "any_all": """
SELECT bool_and(o_totalprice > 0) AS all_priced, bool_or(o_totalprice > 0) AS any_priced,
       count(*) FILTER (o_totalprice > 0) AS n_priced,
       bool_and(o_totalprice > 400000) AS all_large, bool_or(o_totalprice > 400000) AS any_large,
       count(*) FILTER (o_totalprice > 400000) AS n_large,
       bool_and(o_orderstatus = 'O') AS all_open, bool_or(o_orderstatus = 'O') AS any_open,
       count(*) FILTER (o_orderstatus = 'O') AS n_open
FROM orders""",
    "write_read": """
SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""",
    "out_stats": "SELECT count(*) AS row_count, true AS has_bytes FROM lineitem",
    "file_attrs": """
SELECT CASE event_type WHEN 'click' THEN 'TPEP' WHEN 'view' THEN 'LPEP' ELSE 'UNKNOWN' END AS origin,
       CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 ELSE 99 END AS TINYINT) AS origin_id,
       CASE event_type WHEN 'click' THEN 'yellow' WHEN 'view' THEN 'green' END AS taxi,
       CASE WHEN event_type IN ('click', 'view') THEN CAST(2024 AS INTEGER) END AS year,
       CASE WHEN event_type IN ('click', 'view') THEN CAST(1 AS INTEGER) END AS month, count(*) AS n_rows
FROM events GROUP BY ALL""",
    "avg_by_month_orders": f"""
SELECT CAST(month(o_orderdate) AS INTEGER) AS month, {_mean('o_totalprice')} AS avg_o_totalprice FROM orders
WHERE year(o_orderdate) = 1996 AND month(o_orderdate) BETWEEN 1 AND 5 AND o_totalprice >= 0 GROUP BY 1""",
    "avg_by_hour_events": f"""
SELECT CAST(hour(ts) AS INTEGER) AS hour, {_mean('value')} AS avg_value FROM events
WHERE year(ts) = 2024 AND month(ts) = 1 AND value >= 0 GROUP BY 1""",
    "column_profile_orders": _profile("orders"),
    "top_events": """
SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) <= 3""",
    "preview_orders": "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5",
    "schema_drift": """
WITH n AS (SELECT count(o_orderkey) AS k, count(o_custkey) AS c, count(o_orderstatus) AS s, count(o_totalprice) AS t,
                  count(o_orderdate) AS d, count(o_orderpriority) AS p FROM orders)
SELECT v.column_name, v.old_type, v.old_values, v.new_type, v.new_values, v.change FROM n, LATERAL (VALUES
  ('o_orderkey', 'bigint', k, 'bigint', k, 'unchanged'), ('o_custkey', 'bigint', c, 'bigint', c, 'unchanged'),
  ('o_orderstatus', 'string', s, 'string', s, 'unchanged'), ('o_totalprice', 'double', t, 'decimal(18,2)', t, 'retyped'),
  ('o_orderdate', 'timestamp_ntz', d, 'timestamp_ntz', d, 'unchanged'),
  ('o_orderpriority', 'string', p, NULL, NULL, 'dropped'), ('year', NULL, NULL, 'int', d, 'added')
) AS v(column_name, old_type, old_values, new_type, new_values, change)""",
    "schema_history": HISTORY + "SELECT * FROM history",
    "schema_drift_between": HISTORY + """,
pairs AS (SELECT a.n AS old, b.n AS new, a.t AS t_old, b.t AS t_new FROM times a JOIN times b ON a.n < b.n),
sides AS (
  SELECT p.old, p.new, h.column_name,
    max(CASE WHEN valid_from <= t_old AND (valid_to IS NULL OR valid_to > t_old) THEN type END) AS old_type,
    max(CASE WHEN valid_from <= t_new AND (valid_to IS NULL OR valid_to > t_new) THEN type END) AS new_type
  FROM pairs p, history h GROUP BY ALL)
SELECT CAST(old AS INTEGER) AS old, CAST(new AS INTEGER) AS new, column_name, old_type, new_type,
  CASE WHEN old_type IS NULL THEN 'added' WHEN new_type IS NULL THEN 'dropped' WHEN old_type <> new_type THEN 'retyped' ELSE 'unchanged' END AS change
FROM sides WHERE old_type IS NOT NULL OR new_type IS NOT NULL""",
    "plan_lineage": LINEAGE,
    "data_dictionary": " UNION ALL ".join(map(_dictionary_of, TABLES)),
    "schema_of_one_file": """
SELECT CAST(row_number() OVER () AS INTEGER) AS position, column_name FROM (DESCRIBE SELECT * FROM customer)""",
    "printed_schema": """
SELECT 0 AS position, 'root' AS line UNION ALL
SELECT CAST(row_number() OVER () AS INTEGER), ' |-- ' || column_name || ': ' || CASE column_type WHEN 'BIGINT' THEN 'long'
  WHEN 'INTEGER' THEN 'integer' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END
  || ' (nullable = true)'
FROM (DESCRIBE SELECT * FROM lineitem)""",
    "event_transitions": """
SELECT previous_state, event_type, count(*) AS n_events FROM (
  SELECT event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_state FROM events)
WHERE previous_state IS NOT NULL AND NOT (
     (previous_state = 'signup' AND event_type IN ('view', 'click'))
  OR (previous_state IN ('view', 'click') AND event_type IN ('view', 'click', 'purchase'))
  OR (previous_state = 'purchase' AND event_type = 'view'))
GROUP BY ALL""",
    "run_tree": """
SELECT 0 AS depth, 'job' AS job_name, CAST(NULL AS VARCHAR) AS parent_name, CAST(NULL AS VARCHAR) AS root_name,
       'job-' || c_custkey AS top, count(*) AS n_runs FROM customer GROUP BY c_custkey
UNION ALL SELECT 1, 'file', 'job', NULL, 'job-' || o_custkey, count(*) FROM orders GROUP BY o_custkey
UNION ALL SELECT 2, 'step', 'file', 'job', 'job-' || o_custkey, count(DISTINCT (l_orderkey, l_linenumber, l_partkey))
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey""",
    "event_batches": """
SELECT batch_window, CAST(floor(before / 64) AS BIGINT) AS batch_no, count(*) AS n_events,
       CAST(sum(bytes) AS BIGINT) AS n_bytes
FROM (SELECT batch_window, bytes, coalesce(sum(bytes) OVER (
        PARTITION BY batch_window ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM (SELECT *, time_bucket(INTERVAL '6 hours', ts) AS batch_window, strlen(props) AS bytes FROM events))
GROUP BY ALL""",
    "stream_batches": """
WITH RECURSIVE e AS (
  SELECT event_type AS feed, event_id, ts, strlen(props) AS bytes, row_number() OVER (PARTITION BY event_type ORDER BY ts, CAST(event_id AS VARCHAR)) AS n
  FROM events),
walk AS (
  SELECT feed, n, event_id, ts, bytes, CAST(0 AS BIGINT) AS batch_no, ts AS opened_at, CAST(bytes AS BIGINT) AS total, false AS late FROM e WHERE n = 1
  UNION ALL
  SELECT e.feed, e.n, e.event_id, e.ts, e.bytes,
    CASE WHEN total >= 64 OR e.ts >= opened_at + INTERVAL 6 HOUR THEN batch_no + 1 ELSE batch_no END,
    CASE WHEN total >= 64 OR e.ts >= opened_at + INTERVAL 6 HOUR THEN e.ts ELSE opened_at END,
    CASE WHEN total >= 64 OR e.ts >= opened_at + INTERVAL 6 HOUR THEN e.bytes ELSE total + e.bytes END, false
  FROM walk JOIN e ON e.feed = walk.feed AND e.n = walk.n + 1)
SELECT feed, batch_no, opened_at, max(ts) AS last_at, CASE WHEN max(total) >= 64 THEN 'size' ELSE 'time' END AS closed_by,
       count(*) AS n_events, max(total) AS n_bytes, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY n) AS event_ids
FROM walk GROUP BY feed, batch_no, opened_at
HAVING max(total) >= 64 OR opened_at + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events)""",
    "dedup_stream": "SELECT * FROM events",
    "late_events": """
SELECT DISTINCT CASE WHEN event_type <> 'signup' THEN event_id END AS event_id,
       CASE WHEN event_type <> 'purchase' THEN ts END AS ts, user_id, event_type, value, props
FROM events""",
    "touched_days_events": "SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00'",
    "touched": """
SELECT DISTINCT CAST(ts AS DATE) AS day, event_type FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00'""",
    "compaction_gate": """
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n_small, min(ts) AS oldest FROM events GROUP BY 1, 2
HAVING count(*) >= 80 OR (count(*) > 1
  AND floor(epoch(TIMESTAMP '2024-02-01 00:00:00')) - floor(epoch(min(ts))) >= 480 * 3600)""",
    "compaction_queue": """
SELECT 'first' AS run, CAST(ts AS DATE) AS day, event_type, count(*) AS n_files, CAST(sum(strlen(props)) AS BIGINT) AS n_bytes, min(ts) AS oldest
FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY ALL
UNION ALL
SELECT 'second', CAST(ts AS DATE), event_type, count(*), CAST(sum(strlen(props)) AS BIGINT), min(ts)
FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' OR event_type = 'error' GROUP BY ALL""",
    "gold_incremental": """
SELECT o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS avg_o_totalprice, count(*) AS n_rows
FROM orders
WHERE o_totalprice >= 1000 AND CASE
  WHEN year(o_orderdate) = 1996 THEN true
  WHEN year(o_orderdate) = 1994 AND month(o_orderdate) = 1 THEN o_orderstatus = 'F'
  WHEN year(o_orderdate) = 1994 AND month(o_orderdate) = 2 THEN false
  ELSE o_orderkey % 2 = 0 END
GROUP BY 1""",
    "small_files": """
SELECT source, lang, count(*) AS n_files, CAST(sum(n_chars) AS BIGINT) AS n_bytes,
       count(*) FILTER (n_chars < 67108864) AS n_small, count(*) FILTER (n_chars < 131072) AS n_tiny
FROM documents GROUP BY ALL""",
    "retention": """
SELECT event_type, count(*) AS n, CASE WHEN ts >= TIMESTAMP '2024-02-15 00:00:00' - INTERVAL 30 DAY
       THEN 'kept' ELSE 'expired' END AS state FROM events GROUP BY 1, 3""",
    "compact_isolated": """
SELECT CAST(ts AS DATE) AS day, 'compacted' AS status, CAST(1 AS BIGINT) AS files_after, count(*) AS row_count FROM events GROUP BY 1
HAVING min(value) < 10 AND max(value) >= 10
UNION ALL SELECT CAST(max(day) + 365 AS DATE), 'failed', NULL, NULL FROM (
  SELECT CAST(ts AS DATE) AS day FROM events GROUP BY 1 HAVING min(value) < 10 AND max(value) >= 10)""",
    "listed_files": """
SELECT DISTINCT CAST(ts AS DATE) AS day, true AS all_small, true AS has_bytes, CAST(0 AS BIGINT) AS n_expired FROM events""",
    "compact": """
SELECT CAST(ts AS DATE) AS day, 'compacted' AS status, CAST(1 AS BIGINT) AS files_after, count(*) AS row_count,
       count(*) AS rows_now FROM events GROUP BY 1""",
}

ORACLE = {
    **{name: PRELUDE + body for name, body in WITH_TRIPS.items()},
    **{name: PRELUDE + ORDER_LOG + body for name, body in WITH_LOG.items()},
    **PLAIN,
}
