"""The query of benchmark decontamination over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterline.llm.common import read_table
from meterline.llm.decontaminate import contaminations


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return contaminations(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")).drop("text_hash")


QUERIES = {"op1_decontaminate": op1_decontaminate}
ORACLE: dict[str, str] = {}
