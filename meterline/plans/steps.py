"""Named steps and how they follow each other.

A step is a function ``(frame, context) -> frame``. Register more with
:func:`step`, and choose them by name or pass functions of your own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame

from meterline.config import TRIPS, TableSpec
from meterline.functions.rules import Rules, trip_rules
from meterline.operators import columns as cols
from meterline.operators.clean import clean, mark_rows
from meterline.operators.joins import join_zones
from meterline.operators.validate import Contract, trip_contract, validate


@dataclass(frozen=True)
class Context:
    """What steps may need besides the frame. Rules and contract default to the trip ones."""

    spec: TableSpec = TRIPS
    stem: str | Column = ""
    zones: DataFrame | None = None
    zone_join: str = "left"
    broadcast_zones: bool | None = None
    rules: Rules | None = None
    contract: Contract | None = None
    check: Callable[[DataFrame, Contract], DataFrame] = validate

    def having(self, **changes) -> "Context":
        return replace(self, **changes)


Step = Callable[[DataFrame, Context], DataFrame]

REGISTRY: dict[str, Step] = {}

# Cleaning comes before decoding and the zone joins: duplicates are found on the
# narrow rows, and dropped rows are never joined.
DEFAULT_STEPS = (
    "snake_names",
    "canonical_names",
    "tag_origin",
    "cast_types",
    "clean",
    "decode_codes",
    "join_zones",
    "validate",
    "order_columns",
    "describe",
)

# Every row goes on with the names of the rules it breaks, and none is checked yet.
ROUTED_STEPS = tuple("mark" if name == "clean" else name for name in DEFAULT_STEPS if name != "validate")


def step(name: str) -> Callable[[Step], Step]:
    def register(function: Step) -> Step:
        REGISTRY[name] = function
        return function

    return register


step("snake_names")(lambda df, _: cols.snake_names(df))
step("canonical_names")(lambda df, ctx: cols.canonical_names(df, ctx.spec))
step("tag_origin")(lambda df, ctx: cols.tag_origin(df, ctx.spec, ctx.stem))
step("cast_types")(lambda df, ctx: cols.cast_types(df, ctx.spec.types))
step("decode_codes")(lambda df, ctx: cols.decode_codes(df, ctx.spec))
step("order_columns")(lambda df, _: cols.order_columns(df))
step("describe")(lambda df, ctx: cols.describe_columns(df, ctx.spec.dictionary))


@step("clean")
def _clean(df: DataFrame, ctx: Context) -> DataFrame:
    rules = trip_rules() if ctx.rules is None else ctx.rules
    return clean(df, rules, ctx.spec.dropped)


@step("mark")
def _mark(df: DataFrame, ctx: Context) -> DataFrame:
    rules = trip_rules() if ctx.rules is None else ctx.rules
    return mark_rows(df, rules).drop(*ctx.spec.dropped)


@step("join_zones")
def _join_zones(df: DataFrame, ctx: Context) -> DataFrame:
    if ctx.zones is None:
        raise ValueError("the join_zones step needs a zone dimension")
    return join_zones(df, ctx.zones, ctx.spec.zone_roles, ctx.zone_join, ctx.broadcast_zones)


@step("validate")
def _validate(df: DataFrame, ctx: Context) -> DataFrame:
    return ctx.check(df, ctx.contract or trip_contract())


def resolve(steps: Sequence[str | Step] | None = None) -> list[Step]:
    """Names to functions; none given (or an empty list) means the default order."""
    chosen = list(steps or DEFAULT_STEPS)
    unknown = [s for s in chosen if isinstance(s, str) and s not in REGISTRY]
    if unknown:
        valid = ", ".join(sorted(REGISTRY))
        raise ValueError(f"no step is registered as {unknown[0]!r}; there are {valid}")
    return [REGISTRY[s] if isinstance(s, str) else s for s in chosen]


def run_steps(df: DataFrame, context: Context, steps: Sequence[str | Step] | None = None) -> DataFrame:
    for function in resolve(steps):
        df = df.transform(function, context)
    return df
