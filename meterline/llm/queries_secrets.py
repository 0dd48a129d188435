"""The query of the secret scan over the given tables, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import read_table
from meterline.llm.secrets import RULES, scan
from meterline.llm.spans import number_of, written


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = scan(read_table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    order = ("start", "place")
    return found.select(
        "doc_id",
        *(number_of(F.col("spans"), r.kind) for r in RULES if r.base),
        F.sha2(written(base, order).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans"), order).alias("spans"),
    )


def _sql() -> str:
    def lists(place: int) -> str:
        rule = RULES[place]
        pattern = rule.pattern.replace("'", "''")
        return (
            f"string_split_regex(t, '{pattern}') AS p{place}, regexp_extract_all(t, '{pattern}', 0) AS m{place}, "
            f"regexp_extract_all(t, '{pattern}', {rule.group}) AS g{place}"
        )

    def spans(place: int) -> str:
        rule = RULES[place]
        start = f"coalesce(list_sum([length(x) for x in p{place}[1:i]]), 0) + coalesce(list_sum([length(x) for x in m{place}[1:i-1]]), 0)"
        return (
            f"[{{'s': ({start})::INT, 'r': {place}, 'e': ({start} + length(m{place}[i]))::INT, 'k': '{rule.kind}'}} "
            f"for i in range(1, len(m{place}) + 1) if length(g{place}[i]) >= {rule.least}] AS s{place}"
        )

    def joined(which: list[int]) -> str:
        every = "list_concat(" * (len(which) - 1) + f"s{which[0]}" + "".join(f", s{k})" for k in which[1:])
        return f"array_to_string([x.k || ':' || x.s || ':' || x.e for x in list_sort({every})], ',')"

    every = range(len(RULES))
    base = [k for k in every if RULES[k].base]
    return f"""
    WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    cut AS (SELECT doc_id, {", ".join(map(lists, every))} FROM docs),
    placed AS (SELECT doc_id, {", ".join(map(spans, every))} FROM cut)
    SELECT doc_id, {", ".join(f"len(s{k}) AS n_{RULES[k].kind}" for k in base)},
           sha256({joined(base)}) AS base_sha256, {joined(list(every))} AS spans
    FROM placed"""


QUERIES = {"op4_secrets": op4_secrets}
ORACLE = {"op4_secrets": _sql()}
