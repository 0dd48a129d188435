"""The query of the quality classifier over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import fold, read_table
from meterline.llm.quality import fit_and_score

ACCEPTED = 0.3


def folds() -> tuple[Column, Column, Column]:
    """Held out (0 of 5), learned from (2, 3, 4) and calibrated on (1)."""
    part = fold(F.col("doc_id"), 5)
    return part == 0, part.isin(2, 3, 4), part == 1


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    held_out, learn, calibrate = folds()
    scored = fit_and_score(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"), "quality", learn, calibrate)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= ACCEPTED).cast("int").alias("predicted"))


QUERIES = {"op10_quality": op10_quality}
ORACLE: dict[str, str] = {}
