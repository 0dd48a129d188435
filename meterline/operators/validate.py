"""The table contract, checked in one aggregate pass.

Every check becomes one conditional count, so a table is scanned once however
many checks there are. The result is a small table of violations.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from meterline import config
from meterline.functions.rules import (
    Rules,
    holds,
    no_charge_without_fare,
    positive_duration,
    zero_miles_negotiated,
)

VIOLATIONS = "rule string, column_name string, failures bigint"


@dataclass(frozen=True)
class ColumnCheck:
    """``values`` lists what is allowed, ``low``/``high`` bound it (inclusive)."""

    kind: str
    values: tuple[int, ...] = ()
    low: float | None = None
    high: float | None = None
    nullable: bool = False
    required: bool = True


@dataclass(frozen=True)
class Contract:
    columns: Mapping[str, ColumnCheck]
    # Row rules: FALSE is a violation; NULL is one only for the names in ``strict``.
    rules: Rules = field(default_factory=dict)
    strict: frozenset[str] = frozenset()
    not_empty: bool = True
    no_null_columns: bool = False

    def with_rules(self, **rules: Column) -> "Contract":
        """The same contract with more row rules."""
        return Contract(
            self.columns, {**self.rules, **rules}, self.strict, self.not_empty, self.no_null_columns
        )


def trip_contract(no_null_columns: bool = False, exact_duration: bool = False) -> Contract:
    return Contract(
        columns={
            "vendor_id": ColumnCheck("tinyint", values=tuple(config.VENDORS)),
            "pickup_datetime": ColumnCheck("timestamp"),
            "dropoff_datetime": ColumnCheck("timestamp"),
            "passenger_count": ColumnCheck("tinyint", low=0, high=config.MAX_PASSENGERS),
            "trip_distance_mi": ColumnCheck("double", low=0),
            "ratecode_id": ColumnCheck("tinyint", values=tuple(config.RATE_CODES)),
            "fare_amount": ColumnCheck("double"),
            "payment_type_id": ColumnCheck("tinyint", values=tuple(config.PAYMENT_TYPES), required=False),
            "total_amount": ColumnCheck("double"),
        },
        rules={
            "valid_trip_duration": positive_duration(
                "pickup_datetime", "dropoff_datetime", config.MAX_TRIP_HOURS, exact_duration
            ),
            "valid_no_charge_fare": no_charge_without_fare(),
            "valid_negotiated_fare": zero_miles_negotiated(),
        },
        strict=frozenset({"valid_trip_duration"}),
        no_null_columns=no_null_columns,
    )


def schema_violations(df: DataFrame, contract: Contract) -> list[tuple[str, str, int]]:
    """Missing columns and wrong types; reads the schema only."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    found = []
    for name, check in contract.columns.items():
        if name not in kinds:
            if check.required:
                found.append(("column_present", name, 1))
        elif kinds[name] != check.kind:
            found.append(("column_type", name, 1))
    return found


def _value_checks(name: str, check: ColumnCheck) -> dict[str, Column]:
    value, broken = F.col(name), {}
    if not check.nullable:
        broken["not_null"] = value.isNull()
    if check.values:
        broken["in_list"] = ~value.isin(*check.values)
    if check.low is not None:
        broken["at_least"] = value < check.low
    if check.high is not None:
        broken["at_most"] = value > check.high
    return broken


def row_checks(df: DataFrame, contract: Contract) -> list[tuple[str, str, Column]]:
    """(rule, column, condition that is TRUE for a row that fails)."""
    checks: list[tuple[str, str, Column]] = []
    for name, check in contract.columns.items():
        if name in df.columns:
            checks += [(rule, name, broken) for rule, broken in _value_checks(name, check).items()]
    for rule, column in contract.rules.items():
        checks.append((rule, "*", ~holds(column) if rule in contract.strict else ~column))
    return checks


def check_counts(df: DataFrame, contract: Contract) -> list[tuple[str, str, Column]]:
    """(rule, column, aggregate giving the number of failures)."""
    counts = [(rule, name, F.count_if(broken)) for rule, name, broken in row_checks(df, contract)]
    if contract.not_empty:
        counts.append(("not_empty", "*", F.when(F.count("*") == 0, 1).otherwise(0)))
    if contract.no_null_columns:
        empty = [(c, (F.count("*") > 0) & (F.count(F.col(c)) == 0)) for c in df.columns]
        counts += [("has_values", c, F.when(gone, 1).otherwise(0)) for c, gone in empty]
    return counts


def violations(
    df: DataFrame, contract: Contract, by: Sequence[str] = (), only_failed: bool = False
) -> DataFrame:
    """One row per check (and per group of ``by``) with its number of failures."""
    names, aggs = [], []
    for rule, column, agg in check_counts(df, contract):
        names.append(f"{rule}|{column}")
        aggs.append(agg.cast("bigint").alias(names[-1]))
    long = df.groupBy(*by).agg(*aggs).unpivot(list(by), [f"`{n}`" for n in names], "check", "failures")
    check = F.split("check", r"\|", 2)
    report = long.select(*by, check[0].alias("rule"), check[1].alias("column_name"), "failures")
    schema_rows = schema_violations(df, contract)
    if schema_rows:
        extra = df.sparkSession.createDataFrame(schema_rows, VIOLATIONS)
        report = report.unionByName(extra, allowMissingColumns=True)
    return report.filter("failures > 0") if only_failed else report


class ContractError(ValueError):
    """Raised with the failed checks as (rule, column, failures)."""

    def __init__(self, failures: Sequence[tuple]):
        self.failures = list(failures)
        super().__init__(f"contract not met, as (check, column, rows): {self.failures}")


def validate(df: DataFrame, contract: Contract, by: Sequence[str] = ()) -> DataFrame:
    """Return the frame, or raise :class:`ContractError`.

    Runs one job. The driver receives one row per failed check.
    """
    failed = violations(df, contract, by, only_failed=True).collect()
    if failed:
        raise ContractError([tuple(row) for row in failed])
    return df


class WriteCheck:
    """The same checks, counted while a write runs, so that nothing is computed twice.

    ``frame`` goes to the writer; ``raise_if_failed`` is called afterwards,
    before the written files are published.
    """

    def __init__(self, df: DataFrame, contract: Contract):
        self._static = schema_violations(df, contract)
        self._checks = check_counts(df, contract)
        self._observation = Observation()
        names = [f"c{i}" for i in range(len(self._checks))]
        self.frame = df.observe(
            self._observation,
            F.count("*").alias("n_rows"),
            *(agg.cast("bigint").alias(n) for n, (_, _, agg) in zip(names, self._checks)),
        )

    @property
    def row_count(self) -> int:
        return self._observation.get["n_rows"]

    def failures(self) -> list[tuple[str, str, int]]:
        seen = self._observation.get
        counted = [(rule, col, seen[f"c{i}"]) for i, (rule, col, _) in enumerate(self._checks)]
        return self._static + [c for c in counted if c[2] > 0]

    def raise_if_failed(self) -> None:
        failed = self.failures()
        if failed:
            raise ContractError(failed)


class FileCheck:
    """The contract by source, checked while a write runs.

    ``frame`` goes to the writer. What comes back to the driver is, for each
    check, the sources that fail it: a source per file at most, and in a sound
    batch none. Only accepted rows are checked; a source without any fails
    ``not_empty``.
    """

    def __init__(self, df: DataFrame, contract: Contract, source: str, accepted: Column, sources: frozenset[str]):
        self._contract, self._sources = contract, sources
        self._checks = row_checks(df, contract)
        self._static = schema_violations(df, contract)
        self._observation = Observation()
        blamed = (F.collect_set(F.when(accepted & broken, F.col(source))).alias(f"c{i}") for i, (_, _, broken) in enumerate(self._checks))
        self.frame = df.observe(
            self._observation,
            F.count_if(accepted).alias("accepted"),
            F.count_if(~accepted).alias("rejected"),
            F.collect_set(F.when(accepted, F.col(source))).alias("present"),
            *blamed,
        )

    def rows(self) -> dict[str, int]:
        seen = self._observation.get
        return {side: seen[side] for side in ("accepted", "rejected")}

    def failed_sources(self) -> list[tuple[str, str, str]]:
        """(source, rule, column) of each failed check."""
        seen = self._observation.get
        failed = [(s, rule, name) for s in self._sources for rule, name, _ in self._static]
        failed += [(s, rule, name) for i, (rule, name, _) in enumerate(self._checks) for s in seen[f"c{i}"]]
        if self._contract.not_empty:
            failed += [(s, "not_empty", "*") for s in self._sources - set(seen["present"])]
        return sorted(failed)
