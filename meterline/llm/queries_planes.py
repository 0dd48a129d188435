"""The query of the plane files over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import read_table
from meterline.llm.planes import read_ids, write_ids
from meterline.session import scratch_path

VOCABULARY = "byte_bpe_50k.json"


def op5_planes(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "planes")
    write_ids(read_table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY), path)
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {"op5_planes": op5_planes}
ORACLE: dict[str, str] = {}
