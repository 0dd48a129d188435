"""The query of the token counts over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from meterline.llm.common import read_table
from meterline.llm.token_counts import count_tokens

VOCABULARY = "word_bpe_49k.json"


def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(read_table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


QUERIES = {"op13_token_counts": op13_token_counts}
ORACLE: dict[str, str] = {}
