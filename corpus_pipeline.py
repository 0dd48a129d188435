"""From raw documents to token ids: filter, remove near copies, decontaminate, redact, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterline.llm import stages
from meterline.llm.common import stored

STAGES = [
    ("quality classifier", stages.keep_good),
    ("n-gram Jaccard join", stages.keep_one_of_copies),
    ("benchmark decontamination", stages.drop_contaminated),
    ("secret scans", stages.redact_secrets),
    ("byte-level BPE", stages.encode_tokens),
]

#: Trained models and the tokenizer cannot be written in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents after all stages, each written as parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
