"""The query of the personal-data detector over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import read_table
from meterline.llm.pii import BASE, detect
from meterline.llm.spans import number_of, written


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = detect(read_table(spark, folder, "documents"))
    order = ("place", "start")
    base = written(F.filter("spans", lambda s: s["base"]), order)
    return found.select("doc_id", *(number_of(F.col("spans"), kind) for kind in BASE), F.sha2(base.cast("binary"), 256).alias("base_sha256"), written(F.col("spans"), order).alias("spans"))


QUERIES = {"op6_pii": op6_pii}
ORACLE: dict[str, str] = {}
