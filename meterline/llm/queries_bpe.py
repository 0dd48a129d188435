"""The query of the BPE operator over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.bpe import encode
from meterline.llm.common import read_table

RANKS = "byte_bpe_50k.tiktoken"


def digests(encoded: DataFrame) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return digests(encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, with_decoded=True))


QUERIES = {"op3_bpe": op3_bpe}
ORACLE: dict[str, str] = {}
