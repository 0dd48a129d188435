"""Places of regular-expression matches, as columns: leftmost, not overlapping, in code points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start: int, end: int, found: string, inner: string>>"


def places(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches with their start, end (exclusive), text and the text of ``group``.

    The parts between the matches give the places: a match begins where the
    parts and matches before it end. Texts without a match are scanned once.
    """
    between = F.transform(F.split(text, pattern, -1), lambda part: F.length(part))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    steps = F.filter(F.arrays_zip(between.alias("gap"), found.alias("found"), inner.alias("inner")), lambda x: x["found"].isNotNull())

    def add(so_far: Column, step: Column) -> Column:
        start = so_far["at"] + step["gap"]
        end = start + F.length(step["found"])
        span = F.struct(start.alias("start"), end.alias("end"), step["found"].alias("found"), step["inner"].alias("inner"))
        return F.struct(end.alias("at"), F.concat(so_far["spans"], F.array(span)).alias("spans"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))
    return F.when(text.rlike(pattern), F.aggregate(steps, first, add, lambda x: x["spans"])).otherwise(F.array().cast(SPAN))


def written(spans: Column, order: tuple[str, ...]) -> Column:
    """``kind:start:end`` joined by commas; ``order`` names the fields of a span to sort by."""
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(*(s[k].alias(f"by_{k}") for k in order), s["kind"], s["start"], s["end"])))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
