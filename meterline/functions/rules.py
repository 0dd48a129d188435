"""Named keep rules.

A rule is a boolean column that is TRUE for rows to keep. Filtering,
quarantine, reject reports and validation all read the same dictionary, so a
rule is written once. A NULL rule means "cannot tell" and does not keep a row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterline import config
from meterline.functions.clocks import elapsed_micros, elapsed_seconds, miles_per_hour

Rules = dict[str, Column]


def positive_duration(start: str, end: str, max_hours: float, exact: bool = False) -> Column:
    """The end is later than the start, by at most ``max_hours``.

    By default the length is counted in whole seconds, so half a second over the
    bound still passes; ``exact`` counts microseconds.
    """
    length = elapsed_micros(start, end) / 1_000_000 if exact else elapsed_seconds(start, end)
    return (F.col(end) > F.col(start)) & (length <= max_hours * 3600)


def no_charge_without_fare() -> Column:
    return ~((F.col("payment_type_id") == config.NO_CHARGE) & (F.col("fare_amount") > 0))


def zero_miles_negotiated() -> Column:
    metered = F.col("ratecode_id") != config.NEGOTIATED_RATE
    return ~(metered & (F.col("trip_distance_mi") == 0) & (F.col("fare_amount") > 0))


def trip_rules(exact_duration: bool = False) -> Rules:
    seconds = elapsed_seconds("pickup_datetime", "dropoff_datetime")
    return {
        "passengers_in_range": F.col("passenger_count").between(0, config.MAX_PASSENGERS),
        "rate_known": F.col("ratecode_id") != config.UNKNOWN_RATE,
        "duration_possible": positive_duration(
            "pickup_datetime", "dropoff_datetime", config.MAX_TRIP_HOURS, exact_duration
        ),
        "no_charge_without_fare": no_charge_without_fare(),
        "zero_miles_negotiated": zero_miles_negotiated(),
        "speed_possible": miles_per_hour("trip_distance_mi", seconds) <= config.MAX_MPH,
    }


def holds(rule: Column) -> Column:
    """TRUE or FALSE, never NULL."""
    return F.coalesce(rule, F.lit(False))


def all_hold(rules: Rules) -> Column:
    return holds(reduce(lambda kept, rule: kept & rule, rules.values(), F.lit(True)))


def broken_rules(rules: Rules) -> Column:
    """Names of the rules a row breaks, in rule order; names hold no comma.

    Built as text first, because text stays in generated code and a lambda over
    an array does not.
    """
    names = F.concat_ws(",", *(F.when(~holds(rule), F.lit(name)) for name, rule in rules.items()))
    return F.when(names == "", F.array().cast("array<string>")).otherwise(F.split(names, ","))
