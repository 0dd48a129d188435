"""The query of language-model scoring over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import fold, read_table
from meterline.llm.lm import score


def op9_lm(spark: SparkSession, folder: str) -> DataFrame:
    part = fold(F.col("doc_id"), 7)
    scored = score(read_table(spark, folder, "documents"), F.coalesce(part != 2, F.lit(True)), part == 4)
    return scored.select("doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op9_lm": op9_lm}
ORACLE: dict[str, str] = {}
