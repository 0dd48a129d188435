from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from meterline.functions.rules import trip_rules
from meterline.operators.validate import (
    ContractError,
    WriteCheck,
    schema_violations,
    trip_contract,
    validate,
    violations,
)
from meterline.plans.steps import Context, run_steps
from tests.trips import NOON, yellow, yellow_row

CONFORM = ["snake_names", "canonical_names", "tag_origin", "cast_types"]


def conformed(spark, *rows):
    return run_steps(yellow(spark, *rows), Context(stem="yellow"), CONFORM)


def failed(df, contract=None):
    report = violations(df, contract or trip_contract(), only_failed=True)
    return {(r.rule, r.column_name): r.failures for r in report.collect()}


def test_good_trips_pass_and_come_back(spark):
    df = conformed(spark, yellow_row())
    assert validate(df, trip_contract()) is df and failed(df) == {}


BAD = [
    ({"VendorID": 5}, ("in_list", "vendor_id")),
    ({"VendorID": None}, ("not_null", "vendor_id")),
    ({"passenger_count": 7.0}, ("at_most", "passenger_count")),
    ({"passenger_count": -1.0}, ("at_least", "passenger_count")),
    ({"trip_distance": -0.1}, ("at_least", "trip_distance_mi")),
    ({"RatecodeID": 42.0}, ("in_list", "ratecode_id")),
    ({"payment_type": 9}, ("in_list", "payment_type_id")),
    ({"fare_amount": None}, ("not_null", "fare_amount")),
    ({"total_amount": None}, ("not_null", "total_amount")),
    ({"tpep_dropoff_datetime": NOON}, ("valid_trip_duration", "*")),
    ({"tpep_dropoff_datetime": NOON + timedelta(hours=12, seconds=1)}, ("valid_trip_duration", "*")),
    ({"payment_type": 3}, ("valid_no_charge_fare", "*")),
    ({"trip_distance": 0.0}, ("valid_negotiated_fare", "*")),
]


@pytest.mark.parametrize("change,check", BAD)
def test_each_check_fails_alone(spark, change, check):
    assert failed(conformed(spark, yellow_row(), yellow_row(**change))) == {check: 1}


def test_null_times_break_the_duration_but_null_fares_break_no_row_rule(spark):
    assert failed(conformed(spark, yellow_row(tpep_dropoff_datetime=None))) == {
        ("not_null", "dropoff_datetime"): 1,
        ("valid_trip_duration", "*"): 1,
    }
    assert failed(conformed(spark, yellow_row(payment_type=3, fare_amount=None))) == {("not_null", "fare_amount"): 1}


def test_schema_checks(spark):
    df = conformed(spark, yellow_row())
    contract = trip_contract()
    assert schema_violations(df.drop("payment_type_id"), contract) == []
    assert ("column_present", "fare_amount", 1) in schema_violations(df.drop("fare_amount"), contract)
    wide = df.withColumn("vendor_id", F.col("vendor_id").cast("int"))
    assert ("column_type", "vendor_id", 1) in schema_violations(wide, contract)
    assert failed(wide) == {("column_type", "vendor_id"): 1}


def test_empty_tables_and_empty_columns(spark):
    empty = conformed(spark, yellow_row()).filter("false")
    assert failed(empty) == {("not_empty", "*"): 1}
    no_flags = conformed(spark, yellow_row(store_and_fwd_flag=None))
    assert failed(no_flags) == {}
    assert failed(no_flags, trip_contract(no_null_columns=True)) == {("has_values", "store_and_foward"): 1}


def test_own_rules(spark):
    contract = trip_contract().with_rules(cheap=F.col("total_amount") < 5)
    assert failed(conformed(spark, yellow_row()), contract) == {("cheap", "*"): 1}


def test_raises_with_the_failures(spark):
    with pytest.raises(ValueError, match="vendor_id") as caught:
        validate(conformed(spark, yellow_row(VendorID=5)), trip_contract())
    assert caught.value.failures == [("in_list", "vendor_id", 1)]


def test_one_pass(spark):
    plan = violations(conformed(spark, yellow_row()), trip_contract())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and "hashpartitioning" not in plan


def test_write_check_counts_what_the_report_counts(spark):
    df = conformed(spark, yellow_row(VendorID=5), yellow_row(VendorID=5, fare_amount=None), yellow_row())
    check = WriteCheck(df, trip_contract())
    check.frame.write.format("noop").mode("overwrite").save()
    assert {(r, c): n for r, c, n in check.failures()} == failed(df)
    assert check.row_count == 3
    with pytest.raises(ContractError):
        check.raise_if_failed()


def test_cleaning_does_not_promise_the_contract(spark):
    df = run_steps(conformed(spark, yellow_row(VendorID=5)), Context(rules=trip_rules()), ["clean"])
    assert df.count() == 1 and failed(df) == {("in_list", "vendor_id"): 1}
