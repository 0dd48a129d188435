"""One query per operator family, each over whole tables.

Every function takes ``(spark, folder)``. Times leave as naive timestamps and
lists as text, so that other engines can compare them.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.feeds import GREEN_STEM, YELLOW_STEM, green_feed, table, yellow_feed, zone_feed
from checks.landing import land, land_text
from meterline.config import TRIP_DICTIONARY, TRIPS
from meterline.functions.clocks import calendar_parts, duration, elapsed_seconds
from meterline.functions.names import snake_case_text
from meterline.functions.rules import broken_rules, trip_rules
from meterline.operators import columns as cols
from meterline.operators import lineage, schema
from meterline.operators.clean import BROKEN, clean, drop_copies, drop_copies_by_digest, quarantine_split, reject_report
from meterline.plans.column_origins import column_edges
from meterline.operators.joins import decode_by_join, duplicate_keys, fits_broadcast, join_zones, orphan_keys, star_join, star_split
from meterline.operators.ordered import kept
from meterline.operators.profile import column_profile, columns_with_values, output_statistics, table_checks
from meterline.operators.sample import preview, top_per_group
from meterline.operators.union import union_by_name
from meterline.operators.validate import trip_contract, violations
from meterline.plans import gold, maintenance
from meterline.plans.file_queue import VISIBILITY, FileQueue
from meterline.plans.maintenance import file_listing
from meterline.plans.partial_gold import PartialGold
from meterline.plans.publish import publish_files
from meterline.plans.steps import Context, run_steps
from meterline.plans.trips import run_pipeline
from meterline.session import configure, scratch_path
from meterline.sources.files import file_attributes, file_table, list_files, remove
from meterline.sources.footers import empty_columns, footer_table, schema_of_files
from meterline.sources.sinks import write_csv, write_gold, write_partitioned
from meterline.sources.trips import SOURCE, STEM, read_footers, scan_trips, schema_only
from meterline.sources.versions import VersionedTable
from meterline.sources.zones import read_zones, shape_zones
from meterline.streaming.batches import BATCHES, batched
from meterline.streaming.events import EventStore, assign_batches, drop_redeliveries, touched_days
from meterline.streaming.ingest import BatchLoader, landing_files, start_ingest

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

CONFORM = ("snake_names", "canonical_names", "tag_origin", "cast_types")


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(configure(spark), folder)

    QUERIES[function.__name__] = run
    return run


def naive(df: DataFrame) -> DataFrame:
    times = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times}) if times else df


def unchecked(df: DataFrame, _) -> DataFrame:
    return df


def yellow(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return run_steps(yellow_feed(spark, folder), Context(stem=YELLOW_STEM), [*CONFORM, *more])


def green(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return run_steps(green_feed(spark, folder), Context(stem=GREEN_STEM), [*CONFORM, *more])


def silver(spark: SparkSession, folder: str) -> DataFrame:
    """Both feeds through all steps; the feeds break the contract on purpose, so it is not enforced."""
    zones = shape_zones(zone_feed(spark, folder))
    base = Context(zones=zones, broadcast_zones=fits_broadcast(zones), check=unchecked)
    feeds = [(yellow_feed, YELLOW_STEM), (green_feed, GREEN_STEM)]
    return union_by_name([run_steps(feed(spark, folder), base.having(stem=stem)) for feed, stem in feeds])


def stored_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Silver as a written table, for queries that read it several times."""
    path = scratch_path(spark, "silver")
    write_partitioned(cols.add_calendar(silver(spark, folder), "pickup_datetime"), path)
    return spark.read.parquet(path)


def passing_rules() -> dict[str, Column]:
    """The trip rules plus what the contract asks beyond them."""
    return {
        **trip_rules(),
        "vendor_listed": F.col("vendor_id").isin(1, 2, 6, 7),
        "rate_listed": F.col("ratecode_id").isin(1, 2, 3, 4, 5, 6),
        "payment_listed": F.col("payment_type_id").between(0, 6),
        "fare_present": F.col("fare_amount").isNotNull(),
        "total_present": F.col("total_amount").isNotNull(),
    }


# --- names, types, codes, union -------------------------------------------------


@query
def snake_names(spark, folder):
    raw = F.concat(F.regexp_replace("p_brand", "#", ""), "p_type", F.lit("NameID"))
    parts = table(spark, folder, "part").select("p_partkey", raw.alias("raw_name"))
    return parts.withColumn("snake_name", snake_case_text("raw_name"))


@query
def conform_union(spark, folder):
    shape = ("decode_codes", "order_columns")
    return naive(union_by_name([yellow(spark, folder, *shape), green(spark, folder, *shape)]))


@query
def union_relaxed(spark, folder):
    feeds = [cols.snake_names(f(spark, folder)).select("payment_type", "passenger_count") for f in (yellow_feed, green_feed)]
    feeds[1] = feeds[1].withColumn("payment_type", F.col("payment_type").cast("string"))
    both = union_by_name(feeds, relaxed=True)
    return both.groupBy(F.col("payment_type").cast("double").cast("int").alias("payment")).agg(
        F.count("*").alias("n_rows"), F.max("passenger_count").alias("max_passengers")
    )


@query
def decode_codes(spark, folder):
    texts = ["vendor", "ratecode", "payment_type"]
    return yellow(spark, folder, "decode_codes").groupBy(*texts).agg(F.count("*").alias("n_rows"))


@query
def decode_by_codes_table(spark, folder):
    decoded = decode_by_join(green(spark, folder), TRIPS)
    return decoded.groupBy("vendor", "ratecode", "payment_type", "trip_type").agg(F.count("*").alias("n_rows"))


@query
def column_metadata(spark, folder):
    described = cols.describe_columns(silver(spark, folder), TRIP_DICTIONARY)
    return schema.schema_table(described).select(
        "column_name", F.col("description").isNotNull().alias("has_description"), "n_values"
    )


# --- joins ----------------------------------------------------------------------


def _zoned(spark, folder, how):
    keys = ["vendor_id", "pickup_datetime", "fare_amount", "pickup_location_id", "dropoff_location_id"]
    trips = yellow(spark, folder).select(*keys)
    return naive(join_zones(trips, shape_zones(zone_feed(spark, folder)), how=how))


@query
def enrich_roles(spark, folder):
    return _zoned(spark, folder, "left")


@query
def enrich_inner(spark, folder):
    return _zoned(spark, folder, "inner")


@query
def fk_orphans(spark, folder):
    zones = shape_zones(zone_feed(spark, folder))
    return orphan_keys(yellow(spark, folder), zones, "pickup_location_id", "location_id")


@query
def fk_orphans_documents(spark, folder):
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return orphan_keys(documents, labels.withColumnRenamed("doc_id", "labelled_id"), "doc_id", "labelled_id")


@query
def duplicate_zone_keys(spark, folder):
    """The zones' service zones taken for keys: each is shared by the zones of a region."""
    return duplicate_keys(shape_zones(zone_feed(spark, folder)), "service_zone")


@query
def star_split_sizes(spark, folder):
    tables = star_split(stored_silver(spark, folder).drop("year", "month"), TRIPS)
    sizes = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows")) for name, df in tables.items()]
    return union_by_name(sizes)


@query
def star_rejoined(spark, folder):
    wide = stored_silver(spark, folder).drop("year", "month")
    return naive(star_join(star_split(wide, TRIPS), TRIPS).select(*wide.columns))


# --- cleaning -------------------------------------------------------------------


@query
def clean_rules(spark, folder):
    trips = yellow(spark, folder)
    return naive(clean(trips.unionByName(trips), trip_rules()))


@query
def clean_exact_duration(spark, folder):
    return naive(clean(yellow(spark, folder), trip_rules(exact_duration=True)))


@query
def trip_speeds(spark, folder):
    trips = cols.add_speed(yellow(spark, folder), "pickup_datetime", "dropoff_datetime", "trip_distance_mi")
    return trips.groupBy("ratecode_id").agg(
        F.max("mph").alias("max_mph"),
        F.count("mph").alias("n_with_speed"),
        F.sum("elapsed_seconds").alias("sum_seconds"),
    )


@query
def quarantine(spark, folder):
    trips = yellow(spark, folder)
    accepted, rejected = quarantine_split(trips.unionByName(trips), trip_rules())
    both = union_by_name(
        [accepted.select(F.lit("").alias("broken")), rejected.select(F.concat_ws(",", "broken").alias("broken"))]
    )
    return both.groupBy("broken").agg(F.count("*").alias("n_rows"))


@query
def reject_rules(spark, folder):
    return reject_report(yellow(spark, folder), trip_rules())


@query
def dedup_per_file(spark, folder):
    events = table(spark, folder, "events")
    one = events.unionByName(events).withColumn("source", F.lit("first"))
    files = one.unionByName(events.withColumn("source", F.lit("second")))
    per_file = drop_copies(files).groupBy("source", "event_type").agg(F.count("*").alias("n_rows"))
    overall = drop_copies(files.drop("source")).groupBy("event_type").agg(F.count("*").alias("n_rows"))
    return union_by_name([per_file, overall])


@query
def dedup_by_digest(spark, folder):
    """Line items delivered twice by a third of the suppliers, the second time without their tax where they are returned."""
    lines = table(spark, folder, "lineitem")
    again = lines.filter("l_suppkey % 3 = 0").withColumn("l_tax", F.when(F.col("l_returnflag") != "R", F.col("l_tax")))
    once = drop_copies_by_digest(lines.unionByName(again))
    return once.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n_rows"), F.count("l_tax").alias("n_taxed"))


# --- validation -----------------------------------------------------------------


@query
def contract_violations(spark, folder):
    contract = trip_contract(no_null_columns=True).with_rules(
        tip_below_fare=F.col("tip_amount") <= F.abs(F.col("fare_amount"))
    )
    return violations(yellow(spark, folder), contract)


@query
def contract_by_origin(spark, folder):
    both = union_by_name([yellow(spark, folder), green(spark, folder)])
    return violations(both, trip_contract(), by=["origin"], only_failed=True)


@query
def any_all(spark, folder):
    return table_checks(
        table(spark, folder, "orders"),
        priced=F.col("o_totalprice") > 0,
        large=F.col("o_totalprice") > 400000,
        open=F.col("o_orderstatus") == "O",
    )


@query
def null_columns(spark, folder):
    return columns_with_values(green(spark, folder))


@query
def null_columns_pruned(spark, folder):
    return naive(cols.prune_null_columns(green(spark, folder)))


# --- the whole table ------------------------------------------------------------


@query
def silver_trips(spark, folder):
    return naive(silver(spark, folder))


@query
def silver_from_files(spark, folder):
    place = scratch_path(spark, "bronze")
    land(yellow_feed(spark, folder), place, YELLOW_STEM)
    land(green_feed(spark, folder), place, GREEN_STEM)
    context = Context(rules=passing_rules())
    trips = run_pipeline(
        spark, list_files(spark, f"{place}/*_tripdata_1997*.parquet"), zone_lookup=zone_feed(spark, folder), context=context
    )
    return naive(trips)


@query
def write_read(spark, folder):
    path = scratch_path(spark, "orders")
    write_partitioned(cols.add_calendar(table(spark, folder, "orders"), "o_orderdate"), path)
    return spark.read.parquet(path)


@query
def csv_roundtrip(spark, folder):
    path = scratch_path(spark, "zones")
    write_csv(zone_feed(spark, folder), path)
    return read_zones(spark, path, sep=";")


@query
def out_stats(spark, folder):
    path = scratch_path(spark, "stats")
    table(spark, folder, "lineitem").write.parquet(path)
    stats = output_statistics(spark, path)
    return stats.select("row_count", (F.col("size_bytes") > 0).alias("has_bytes"))


@query
def file_attrs(spark, folder):
    place = scratch_path(spark, "named")
    events = table(spark, folder, "events")
    kind = F.col("event_type")
    land(events.filter(kind == "click"), place, "yellow", "2024-01")
    land(events.filter(kind == "view"), place, "green", "2024-01")
    land(events.filter(~kind.isin("click", "view")), place, "other", "2024-01")
    scans = scan_trips(spark, list_files(spark, f"{place}/*.parquet"))
    tagged = cols.tag_origin(union_by_name([s.frame for s in scans]), TRIPS, F.col(STEM))
    per_file = tagged.groupBy(SOURCE, "origin", "origin_id").agg(F.count("*").alias("n"))
    attributes = file_attributes(per_file.select(SOURCE), SOURCE)
    return (
        per_file.join(attributes, SOURCE, "left")
        .groupBy("origin", "origin_id", "taxi", "year", "month")
        .agg(F.sum("n").alias("n_rows"))
    )


# --- questions and profiles -----------------------------------------------------


@query
def named_steps(spark, folder):
    """Steps chosen by name, with a function of one's own among them."""

    def seconds(df, _):
        return cols.add_speed(df, "pickup_datetime", "dropoff_datetime", "trip_distance_mi")

    trips = run_steps(green_feed(spark, folder), Context(stem=GREEN_STEM), [*CONFORM, "clean", seconds])
    return trips.groupBy("vendor_id").agg(F.count("*").alias("n_trips"), F.max("elapsed_seconds").alias("longest"))


@query
def avg_by_month(spark, folder):
    return gold.average_by_month(silver(spark, folder), year=1997, cents=True)


@query
def avg_by_hour(spark, folder):
    return gold.average_by_hour(silver(spark, folder), year=1997, month=5, cents=True)


@query
def avg_by_month_orders(spark, folder):
    return gold.average_by_month(
        table(spark, folder, "orders"), 1996, origin_id=None, ts="o_orderdate", amount="o_totalprice", cents=True
    )


@query
def avg_by_hour_events(spark, folder):
    return gold.average_by_hour(
        table(spark, folder, "events"), 2024, 1, ts="ts", amount="value", value="value", cents=True
    )


GOLD_MODEL = """
    SELECT month(pickup_datetime) AS month, origin,
           CAST(sum(CAST(total_amount AS DECIMAL(18, 2))) AS DOUBLE) / count(total_amount) AS avg_total_amount
    FROM silver WHERE year = 1997 AND total_amount >= 0 GROUP BY month(pickup_datetime), origin
"""


@query
def gold_incremental(spark, folder):
    """Averages kept up to date through late files, a replaced partition and an emptied one."""
    place = scratch_path(spark, "incremental")
    orders = cols.add_calendar(table(spark, folder, "orders"), "o_orderdate")
    write_partitioned(orders.filter("o_orderkey % 2 = 0"), f"{place}/orders")
    result = PartialGold(spark, f"{place}/gold", {"o_orderpriority": F.col("o_orderpriority")}, "o_totalprice", where=F.col("o_totalprice") >= 1000)
    result.refresh(spark.read.parquet(f"{place}/orders"))
    write_partitioned(orders.filter("o_orderkey % 2 = 1 AND year = 1996"), f"{place}/orders", replace="none")
    write_partitioned(orders.filter("o_orderstatus = 'F' AND year = 1994 AND month = 1"), f"{place}/orders", replace="touched")
    remove(spark, f"{place}/orders/year=1994/month=2")
    changed = orders.filter("year = 1996 OR (year = 1994 AND month IN (1, 2))").select("year", "month")
    result.refresh(spark.read.schema(orders.schema).parquet(f"{place}/orders"), changed)
    return result.table()


@query
def gold_sql(spark, folder):
    stored_silver(spark, folder).createOrReplaceTempView("silver")
    return write_gold(spark, GOLD_MODEL, scratch_path(spark, "gold"))


@query
def column_profile_orders(spark, folder):
    return column_profile(table(spark, folder, "orders"))


@query
def column_profile_trips(spark, folder):
    return column_profile(yellow(spark, folder))


@query
def stratified_sample(spark, folder):
    columns = ["pickup_datetime", "dropoff_datetime", "fare_amount", "trip_distance_mi", "vendor_id", "origin_id"]
    keys = ["store_and_foward", "payment_type_id"]
    return naive(top_per_group(silver(spark, folder).select(*keys, *columns), keys, columns))


@query
def top_events(spark, folder):
    order = [F.col("value").desc(), F.col("event_id")]
    return top_per_group(table(spark, folder, "events"), ["event_type"], order, k=3)


@query
def preview_orders(spark, folder):
    return preview(table(spark, folder, "orders"), [F.col("o_totalprice").desc(), F.col("o_orderkey")])


@query
def durations(spark, folder):
    trips = yellow(spark, folder)
    length = duration("pickup_datetime", "dropoff_datetime")
    seconds = elapsed_seconds("pickup_datetime", "dropoff_datetime")
    return trips.groupBy("vendor_id").agg(
        F.sum(seconds).alias("sum_seconds"),
        F.min(seconds).alias("min_seconds"),
        F.max(length).cast("interval second").cast("decimal(18,6)").cast("double").alias("max_duration"),
    )


@query
def group_nulls(spark, folder):
    return yellow(spark, folder).groupBy("payment_type_id", "store_and_foward").agg(F.count("*").alias("n_rows"))


@query
def calendar_counts(spark, folder):
    trips = yellow(spark, folder)
    parts = calendar_parts("pickup_datetime", "year", "month", "hour")
    kept = trips.filter(parts["month"].between(1, 6))
    return kept.groupBy(*(c.alias(name) for name, c in parts.items())).agg(F.count("*").alias("n_trips"))


# --- schemas and lineage --------------------------------------------------------


def _schemas(spark, folder):
    tagged = [
        schema.schema_table(feed(spark, folder)).select(F.lit(kind).alias("kind"), F.lit(1997).alias("year"), F.lit(1).alias("month"), "*")
        for kind, feed in (("yellow", yellow_feed), ("green", green_feed))
    ]
    return union_by_name(tagged)


@query
def schema_diff(spark, folder):
    schemas = _schemas(spark, folder)
    overlap = schema.schema_overlap(schemas, by=["year", "month"])
    values = schemas.groupBy("column_name").agg(F.sum("n_values").alias("n_values"))
    return overlap.join(values, "column_name").withColumn("kinds", F.concat_ws(",", "kinds"))


@query
def schema_diff_counts(spark, folder):
    schemas = _schemas(spark, folder).filter("n_values > 0")
    return schema.overlap_counts(schema.schema_overlap(schemas, by=["year", "month"]), by=["year", "month"])


def _two_months(spark, folder):
    """The footers of both feeds landed for two months; February's yellow files lack a column and have an empty one."""
    place = scratch_path(spark, "months")
    land(yellow_feed(spark, folder), place, "yellow_tripdata", "1997-01")
    land(green_feed(spark, folder), place, "green_tripdata", "1997-01")
    later = yellow_feed(spark, folder).filter("PULocationID <= 25").drop("tip_amount")
    land(later.withColumn("congestion_surcharge", F.lit(None).cast("double")), place, "yellow_tripdata", "1997-02")
    land(green_feed(spark, folder).filter("PULocationID > 6"), place, "green_tripdata", "1997-02")
    return file_attributes(footer_table(spark, place))


@query
def schema_of_one_file(spark, folder):
    place = scratch_path(spark, "one")
    land(table(spark, folder, "customer"), place, "customers")
    names = schema_only(spark, list_files(spark, f"{place}/*.parquet")[0])
    return spark.createDataFrame(list(enumerate(names, start=1)), "position int, column_name string")


@query
def printed_schema(spark, folder):
    return schema.schema_lines(table(spark, folder, "lineitem"))


@query
def zone_dictionary(spark, folder):
    """Which columns of the zone dimension have a description, and how many values they hold."""
    path = scratch_path(spark, "zones")
    write_csv(zone_feed(spark, folder), path)
    described = schema.schema_table(read_zones(spark, path, sep=";"))
    return described.select("column_name", "type", F.col("description").isNotNull().alias("described"), "n_values")


@query
def schema_from_files(spark, folder):
    schemas = schema_of_files(_two_months(spark, folder), by=["taxi", "year", "month"])
    return schemas.select("taxi", "year", "month", "column_name", "position", "type", "n_rows", "n_values")


@query
def columns_of_one_kind(spark, folder):
    schemas = schema_of_files(_two_months(spark, folder), by=["taxi", "year", "month"])
    overlap = schema.schema_overlap(schemas, by=["year", "month"], kind="taxi")
    return schema.only_in_kind(overlap, by=["year", "month"]).withColumn("columns", F.concat_ws(",", "columns"))


@query
def empty_columns_of_files(spark, folder):
    return empty_columns(_two_months(spark, folder))


@query
def schema_drift(spark, folder):
    old = table(spark, folder, "orders")
    new = (
        cols.add_calendar(old, "o_orderdate", "year")
        .withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
        .drop("o_orderpriority")
    )
    return schema.drift(schema.schema_table(old), schema.schema_table(new))


def _history(spark, folder):
    """Four snapshots of the orders' schema; the priority leaves and returns, the price changes its type for good."""
    orders = table(spark, folder, "orders")
    priced = orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    versions = [orders, orders.drop("o_orderpriority"), priced, cols.add_calendar(priced, "o_orderdate", "year")]
    moment = lambda k: F.expr(f"timestampadd(DAY, {k}, min(o_orderdate))")
    times = [F.lit(t).cast("timestamp_ntz") for t in orders.agg(*(moment(7 * k) for k in range(len(versions)))).first()]
    snapshots = [schema.schema_table(df, counted=False).withColumn("taken_at", t) for df, t in zip(versions, times)]
    return schema.schema_history(union_by_name(snapshots)), times


@query
def schema_history(spark, folder):
    return _history(spark, folder)[0]


@query
def schema_drift_between(spark, folder):
    """The drift between each two of the snapshots."""
    history, at = _history(spark, folder)
    pairs = [(a, b) for a in range(4) for b in range(a + 1, 4)]
    return union_by_name([schema.drift_between(history, at[a], at[b]).select(F.lit(a).alias("old"), F.lit(b).alias("new"), "*") for a, b in pairs])


@query
def plan_lineage(spark, folder):
    """Raw columns behind each silver column of a yellow trip, with the values that each of them has."""
    raw, zones = yellow_feed(spark, folder), zone_feed(spark, folder)
    context = Context(stem=YELLOW_STEM, zones=shape_zones(zones), broadcast_zones=True, check=unchecked)
    edges = column_edges(run_steps(raw, context), {"trips": raw, "nation": table(spark, folder, "nation"), "region": table(spark, folder, "region")})
    counts = schema.data_dictionary({"trips": table(spark, folder, "lineitem"), "nation": table(spark, folder, "nation"), "region": table(spark, folder, "region")})
    counts = counts.select(F.col("table_name").alias("dataset"), F.col("column_name").alias("input_column"), "n_values")
    return edges.join(counts, ["dataset", "input_column"], "left").select("output_column", "dataset", "input_column", "kind", "n_values")


@query
def data_dictionary(spark, folder):
    tables = {name: table(spark, folder, name) for name in TABLES}
    return schema.data_dictionary(tables).select("table_name", "column_name", "position", "type", "n_values")


@query
def dictionary_gaps(spark, folder):
    raw = cols.snake_names(yellow_feed(spark, folder))
    return schema.dictionary_gaps(schema.schema_table(raw), TRIP_DICTIONARY).select("column_name", "n_values")


@query
def dataset_facets(spark, folder):
    facets = schema.dataset_facets(
        silver(spark, folder), "silver_trips", TRIP_DICTIONARY, source_uri="silver", owner="lake team", overwritten=True
    )
    return facets.drop("description")


@query
def column_lineage(spark, folder):
    raw = union_by_name([cols.snake_names(f(spark, folder)) for f in (yellow_feed, green_feed)], relaxed=True)
    edges = lineage.column_lineage(raw, TRIPS.renames)
    return edges.withColumn("input_columns", F.concat_ws(",", "input_columns"))


EVENT_ORDER = {
    "signup": ["view", "click"],
    "view": ["view", "click", "purchase"],
    "click": ["view", "click", "purchase"],
    "purchase": ["view"],
    "error": [],
}


@query
def event_transitions(spark, folder):
    log = table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type")
    wrong = lineage.invalid_transitions(log, EVENT_ORDER, "user_id", ("ts", "event_id"), initial=None)
    return wrong.groupBy("previous_state", "event_type").agg(F.count("*").alias("n_events"))


STEPS = ("conform", "clean", "validate")


def _order_log(spark, folder):
    """A run log with one job, a run per order and a run per step; lineitems give the row counts."""
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    orders = table(spark, folder, "orders")
    failed = F.col("o_orderstatus") == "P"
    start = F.col("o_orderdate").cast("timestamp")
    outcomes = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").select(
        F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("source"),
        start.alias("started_at"),
        (start + F.expr("INTERVAL 10 MINUTES")).alias("finished_at"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("row_count"),
        (F.coalesce("n", F.lit(0)) * 100).cast("bigint").alias("size_bytes"),
        F.when(failed, "clean").alias("failed_step"),
        F.when(failed, "pending").alias("error_message"),
        F.when(failed, "pending in clean").alias("stack_trace"),
    )
    return lineage.run_events(outcomes, "orders", STEPS)


@query
def run_log(spark, folder):
    log = _order_log(spark, folder).withColumn("input_name", F.col("inputs")[0]["name"])
    return naive(log.drop("inputs", "outputs"))


@query
def run_failures(spark, folder):
    failed = lineage.failures(_order_log(spark, folder))
    return failed.groupBy("job_namespace", F.col("error_message")).agg(F.count("*").alias("n_runs"))


@query
def run_log_validity(spark, folder):
    log = kept(_order_log(spark, folder).select("run_id", "event_time", "seq", "event_type", "job_namespace"), "log")
    late = log.filter((F.col("job_namespace") == "run_steps") & (F.col("event_type") == "COMPLETE")).withColumns(
        {"event_type": F.lit("RUNNING"), "seq": F.col("seq") + 1}
    )
    wrong = lineage.invalid_transitions(log.unionByName(late))
    return wrong.groupBy("previous_state", "event_type").agg(F.count("*").alias("n_events"))


@query
def run_tree(spark, folder):
    text = lambda *parts: F.concat_ws("-", *(F.col(p).cast("string") for p in parts))
    customers = table(spark, folder, "customer").select(
        text("c_custkey").alias("c"), F.lit(None).cast("string").alias("p"), F.lit("job").alias("kind")
    )
    orders = table(spark, folder, "orders").select(
        text("o_orderkey").alias("c"), F.concat(F.lit("job-"), text("o_custkey")).alias("p"), F.lit("file").alias("kind")
    )
    lines = table(spark, folder, "lineitem").select(
        text("l_orderkey", "l_linenumber", "l_partkey").alias("c"),
        F.concat(F.lit("file-"), text("l_orderkey")).alias("p"),
        F.lit("step").alias("kind"),
    )
    log = union_by_name([customers, orders, lines]).select(
        F.lit("START").alias("event_type"),
        F.concat("kind", F.lit("-"), "c").alias("run_id"),
        F.col("p").alias("parent_run_id"),
        F.col("kind").alias("job_name"),
    )
    tree = lineage.run_tree(log)
    return tree.groupBy("depth", "job_name", "parent_name", "root_name", F.coalesce("root_run_id", "parent_run_id", "run_id").alias("top")).agg(
        F.count("*").alias("n_runs")
    )


# --- streams --------------------------------------------------------------------


@query
def event_batches(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts", "props")
    batched = assign_batches(events, "ts", ["event_id"], F.octet_length("props"), "6 hours", 64)
    return batched.groupBy("batch_window", "batch_no").agg(
        F.count("*").alias("n_events"), F.sum(F.octet_length("props")).cast("bigint").alias("n_bytes")
    )


@query
def stream_batches(spark, folder):
    """Events as a stream of three days' files, stopped and started again after the second file."""
    place = scratch_path(spark, "batches")
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    bounds = ["2024-01-01", "2024-01-09", "2024-01-20", "2024-02-02"]
    for first, last, run in zip(bounds, bounds[1:], (False, True, True)):
        between = (F.col("ts") >= F.lit(first).cast("timestamp")) & (F.col("ts") < F.lit(last).cast("timestamp"))
        events.filter(between).coalesce(1).write.mode("append").parquet(f"{place}/landing")
        if run:
            stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{place}/landing")
            closed = batched(stream, "event_type", "event_id", "ts", F.octet_length("props"), max_bytes=64, window=timedelta(hours=6))
            writer = closed.writeStream.format("parquet").option("path", f"{place}/out").option("checkpointLocation", f"{place}/checkpoint")
            writer.trigger(availableNow=True).start().awaitTermination()
    batches = spark.read.schema(BATCHES).parquet(f"{place}/out")
    return naive(batches.withColumn("event_ids", F.concat_ws(",", "event_ids")))


@query
def dedup_stream(spark, folder):
    place = scratch_path(spark, "redelivered")
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for delivery in ("first", "second"):
        events.write.parquet(f"{place}/landing/{delivery}")
    stream = (
        spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(f"{place}/landing")
    )
    once = drop_redeliveries(stream, ["event_id"], "ts")
    run = (
        once.writeStream.format("parquet")
        .option("path", f"{place}/out")
        .option("checkpointLocation", f"{place}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return naive(spark.read.schema(events.schema).parquet(f"{place}/out"))


@query
def late_events(spark, folder):
    """Three micro-batches, the newest days first, each with the one before delivered again.

    Purchases lose their time and sign-ups their id, so that either can be missing."""
    place = scratch_path(spark, "late")
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    part = F.when(F.col("ts") >= F.lit("2024-01-21").cast("timestamp"), 1).when(F.col("ts") >= F.lit("2024-01-11").cast("timestamp"), 2).otherwise(3)
    parts = events.withColumn("part", part).withColumns(
        {"ts": F.when(F.col("event_type") != "purchase", F.col("ts")), "event_id": F.when(F.col("event_type") != "signup", F.col("event_id"))}
    )
    store = EventStore(f"{place}/store", ["event_id"], "ts")
    for n in (1, 2, 3):
        parts.filter(F.col("part").isin(n, n - 1)).drop("part").write.parquet(f"{place}/landing/{n}")
        stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(f"{place}/landing")
        writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", f"{place}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    return naive(spark.read.parquet(f"{place}/store").select(*events.columns))


def _ingest(spark, folder, place, max_files):
    loader = BatchLoader(
        spark,
        zone_feed(spark, folder),
        f"{place}/silver",
        f"{place}/dead_letter",
        Context(rules=passing_rules()),
    )
    landing = landing_files(spark, f"{place}/landing", max_files=max_files)
    start_ingest(landing, loader, f"{place}/checkpoint", every=None).awaitTermination()


@query
def ingest_stream(spark, folder):
    place = scratch_path(spark, "ingest")
    land(yellow_feed(spark, folder), f"{place}/landing", YELLOW_STEM)
    land(green_feed(spark, folder), f"{place}/landing", GREEN_STEM)
    _ingest(spark, folder, place, max_files=50)
    trips = spark.read.parquet(f"{place}/silver")
    return trips.groupBy("origin", "year", "month").agg(F.count("*").alias("n_trips"))


def _published(spark, folder, place, rules):
    """Both feeds, as files, through the stream into a versioned table; the batch is then replayed."""
    table_ = VersionedTable(spark, f"{place}/silver")
    land(yellow_feed(spark, folder), f"{place}/landing", YELLOW_STEM)
    land(green_feed(spark, folder), f"{place}/landing", GREEN_STEM)
    loader = BatchLoader(spark, zone_feed(spark, folder), table_, f"{place}/dead_letter", Context(rules=rules))
    start_ingest(landing_files(spark, f"{place}/landing", max_files=1000), loader, f"{place}/checkpoint", None).awaitTermination()
    name = table_.version().names()[0]
    stream, batch = name.split("/")
    loader.load(list_files(spark, f"{place}/landing/*.parquet"), int(batch), stream)
    return table_


@query
def quarantine_rows(spark, folder):
    """Every distinct row is on one of the two sides, the rejected ones with the rules they break."""
    table_ = _published(spark, folder, scratch_path(spark, "routed"), passing_rules())
    sides = [table_.read(v, keep=[BROKEN]).select(F.lit(v).alias("verdict"), "origin", F.concat_ws(",", BROKEN).alias("broken"), F.month("pickup_datetime").alias("month")) for v in ("accepted", "rejected")]
    return union_by_name(sides).groupBy("verdict", "origin", "broken", "month").agg(F.count("*").alias("n_rows"))


@query
def ingest_log(spark, folder):
    """What the run log says of the files of each kind, against the manifest and the file listing."""
    place = scratch_path(spark, "logged")
    land(yellow_feed(spark, folder), f"{place}/landing", YELLOW_STEM)
    land(green_feed(spark, folder), f"{place}/landing", GREEN_STEM)
    loader = BatchLoader(spark, zone_feed(spark, folder), VersionedTable(spark, f"{place}/silver"), f"{place}/dead", Context(rules=passing_rules()), f"{place}/log")
    start_ingest(landing_files(spark, f"{place}/landing", max_files=1000), loader, f"{place}/checkpoint", None).awaitTermination()
    done = spark.read.parquet(f"{place}/log").filter("job_namespace = 'run_steps' AND event_type = 'COMPLETE'")
    there = file_listing(spark, f"{place}/landing").select(F.regexp_replace("path", "^file:/+", "/").alias("job_name"), "length")
    kind = F.regexp_extract("job_name", r"([a-z]+)_tripdata", 1).alias("kind")
    return done.join(there, "job_name").groupBy(kind).agg(F.sum("row_count").alias("n_trips"), F.bool_and(F.col("size_bytes") == F.col("length")).alias("sizes_agree"))


@query
def published_sources(spark, folder):
    """What the manifest of the newest version says of each kind of source file."""
    table_ = _published(spark, folder, scratch_path(spark, "manifest"), passing_rules())
    kind = F.regexp_extract("source", r"([a-z]+)_tripdata", 1)
    return table_.manifest().groupBy(kind.alias("kind"), "verdict").agg(F.sum("n_rows").alias("n_rows"))


@query
def file_contract(spark, folder):
    """Failures by file: every yellow trip has a vendor outside the list, so those files are named and left out."""
    place = scratch_path(spark, "contract")
    land(yellow_feed(spark, folder).withColumn("VendorID", F.lit(8).cast("bigint")), place, YELLOW_STEM)
    land(green_feed(spark, folder), place, GREEN_STEM)
    rules = {k: v for k, v in passing_rules().items() if k != "vendor_listed"}
    footers = read_footers(spark, list_files(spark, f"{place}/*.parquet"))
    silver_table = VersionedTable(spark, f"{place}/silver")
    report = publish_files(silver_table, footers, zone_feed(spark, folder), "job", Context(rules=rules), isolate=True)
    failures = spark.createDataFrame(report.failures, "source string, rule string, column_name string, n_rows bigint")
    kept = silver_table.read().groupBy().agg(F.lit("green").alias("kind"), F.lit("published").alias("rule"), F.lit("*").alias("column_name"), F.count("*").alias("n_rows"))
    kind = F.regexp_extract("source", r"([a-z]+)_tripdata", 1).alias("kind")
    return failures.groupBy(kind, "rule", "column_name").agg(F.sum("n_rows").alias("n_rows")).unionByName(kept)


@query
def bad_file(spark, folder):
    place = scratch_path(spark, "bad")
    kind = F.regexp_extract("path", r"([a-z]+)_tripdata", 1)
    green_rows, yellow_rows = green_feed(spark, folder), yellow_feed(spark, folder)
    land(green_rows, f"{place}/landing", GREEN_STEM)
    # Every trip of this file has a vendor outside the list, so the file breaks the contract.
    land(yellow_rows.withColumn("VendorID", F.lit(8).cast("bigint")), f"{place}/landing", YELLOW_STEM)
    land_text(table(spark, folder, "documents").select("text"), f"{place}/landing", "broken_tripdata_1997-01")
    rules = {k: v for k, v in passing_rules().items() if k != "vendor_listed"}
    loader = BatchLoader(
        spark, zone_feed(spark, folder), f"{place}/silver", f"{place}/dead_letter", Context(rules=rules)
    )
    start_ingest(landing_files(spark, f"{place}/landing"), loader, f"{place}/checkpoint", None).awaitTermination()
    landed = file_listing(spark, f"{place}/landing").select(kind.alias("name")).groupBy("name").agg(F.count("*").alias("landed"))
    letters = spark.read.parquet(f"{place}/dead_letter").withColumnRenamed("source_file", "path")
    letters = letters.groupBy(F.col("reason").alias("outcome"), kind.alias("name")).agg(F.count("*").alias("letters"))
    # As many letters as files: each bad file has one, and only one.
    letters = letters.join(landed, "name").select("outcome", "name", (F.col("letters") == F.col("landed")).alias("each_once"), F.lit(None).cast("bigint").alias("n_trips"))
    loaded = spark.read.parquet(f"{place}/silver").groupBy(F.col("origin").alias("name")).agg(F.count("*").alias("n_trips"))
    return union_by_name([letters, loaded.withColumns({"outcome": F.lit("loaded"), "each_once": F.lit(None).cast("boolean")})])


# --- maintenance ----------------------------------------------------------------


@query
def touched_days_events(spark, folder):
    return touched_days(table(spark, folder, "events"), "ts", F.expr("TIMESTAMP_NTZ'2024-01-20 12:00:00'"))


def _events_as_files(spark, folder):
    """Each event stands for a written file: when, how large, and in which partition."""
    return table(spark, folder, "events").select(
        F.to_date("ts").alias("day"), "event_type", F.col("ts").alias("changed"), F.octet_length("props").cast("bigint").alias("length")
    )


@query
def touched(spark, folder):
    files = _events_as_files(spark, folder)
    since = F.expr("TIMESTAMP_NTZ'2024-01-20 12:00:00'")
    return maintenance.touched_partitions(files, ["day", "event_type"], since, changed="changed")


@query
def compaction_gate(spark, folder):
    return maintenance.compaction_gate(
        _events_as_files(spark, folder),
        ["day", "event_type"],
        min_files=80,
        now=F.expr("TIMESTAMP_NTZ'2024-02-01 00:00:00'"),
        max_age_hours=24 * 20,
        changed="changed",
    )


@query
def compaction_queue(spark, folder):
    """File events drained in two runs: errors fail in the first, and a run between the two dies with what it took."""
    files = _events_as_files(spark, folder)
    early = F.col("changed") < F.expr("TIMESTAMP_NTZ'2024-01-15 00:00:00'")
    queue = FileQueue(spark, scratch_path(spark, "queue"), ["day", "event_type"])
    moment = datetime(2024, 2, 1, tzinfo=timezone.utc)
    for _ in range(2):  # announced twice
        queue.arrive("early", files.filter(early), changed="changed")
    first = queue.drain("first", moment)
    queue.acknowledge("first", first.filter("event_type <> 'error'"))
    queue.arrive("late", files.filter(~early), changed="changed")
    queue.drain("lost", moment)
    second = queue.drain("second", moment + VISIBILITY)
    return naive(union_by_name([first.withColumn("run", F.lit("first")), second.withColumn("run", F.lit("second"))]))


@query
def small_files(spark, folder):
    return maintenance.small_files(table(spark, folder, "documents"), ["source", "lang"], size="n_chars")


@query
def retention(spark, folder):
    now = F.expr("TIMESTAMP_NTZ'2024-02-15 00:00:00'")
    events = table(spark, folder, "events")
    kept = maintenance.within_retention(events, "ts", now).groupBy("event_type").agg(F.count("*").alias("n"))
    gone = maintenance.expired_files(events, now, changed="ts").groupBy("event_type").agg(F.count("*").alias("n"))
    return union_by_name([kept.withColumn("state", F.lit("kept")), gone.withColumn("state", F.lit("expired"))])


@query
def compact(spark, folder):
    path = scratch_path(spark, "compact")
    events = table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    for kind in (F.col("value") < 10, F.col("value") >= 10):
        events.filter(kind).write.partitionBy("day").mode("append").parquet(path)
    days = spark.read.parquet(path).select("day").distinct()
    report = maintenance.compact(spark, path, days, ["day"])
    counts = spark.read.parquet(path).groupBy("day").agg(F.count("*").alias("rows_now"))
    return (
        report.withColumn("day", F.to_date(F.regexp_extract("partition", "day=(.*)$", 1)))
        .join(counts, "day")
        .select("day", "status", "files_after", "row_count", "rows_now")
    )


def _events_in_files(spark, folder, name):
    path = scratch_path(spark, name)
    events = table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    for kind in (F.col("value") < 10, F.col("value") >= 10):
        events.filter(kind).write.partitionBy("day").mode("append").parquet(path)
    return path


@query
def compact_isolated(spark, folder):
    """Compaction of the touched partitions by the real listing, and of one that is not there: it fails alone."""
    path = _events_in_files(spark, folder, "isolated")
    files = file_table(spark, path)
    due = maintenance.compaction_gate(files, ["day"], min_files=2).select("day")
    touched_now = maintenance.touched_partitions(files, ["day"], F.lit("2020-01-01").cast("timestamp")).join(due, "day", "left_semi")
    missing = touched_now.agg(F.date_add(F.max("day"), 365).alias("day"))
    report = maintenance.compact(spark, path, touched_now.unionByName(missing), ["day"])
    return report.select(F.to_date(F.regexp_extract("partition", "day=(.*)$", 1)).alias("day"), "status", "files_after", "row_count")


@query
def listed_files(spark, folder):
    """Small and expired files by the real listing; all were written just now."""
    files = file_table(spark, _events_in_files(spark, folder, "listed"))
    state = maintenance.small_files(files, ["day"]).select("day", (F.col("n_small") == F.col("n_files")).alias("all_small"), (F.col("n_bytes") > 0).alias("has_bytes"))
    expired = maintenance.expired_files(files, F.current_timestamp()).groupBy("day").agg(F.count("*").alias("n_expired"))
    return state.join(expired, "day", "left").fillna({"n_expired": 0})


@query
def broken_rule_names(spark, folder):
    """The rules each green trip breaks, as a list beside the trip."""
    marked = green(spark, folder).withColumn("broken", F.concat_ws(",", broken_rules(trip_rules())))
    return naive(marked.select("pickup_datetime", "fare_amount", "ratecode_id", "payment_type_id", "broken"))
