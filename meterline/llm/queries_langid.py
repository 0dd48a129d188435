"""The query of language identification over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import fold, read_table
from meterline.llm.langid import label, train


def op7_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    chain = train(docs, ~held_out)
    return label(docs, chain).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "runs")


QUERIES = {"op7_langid": op7_langid}
ORACLE: dict[str, str] = {}
