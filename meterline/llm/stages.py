"""The stages of the corpus pipeline: each is one operator whose decisions take effect on the documents.

All but the last return the columns of documents, and rows that they keep
unchanged but for what the operator itself changes. Every stage gives an empty
table for an empty one, leaves further columns behind and takes a null text for
an empty one when it decides, without changing it. Rows with equal ids, or
without one, are rows of their own in every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import decontaminate, jaccard
from meterline.llm.bpe import encode
from meterline.llm.common import limit_batches, read_table, small_batches, stored
from meterline.llm.queries_bpe import RANKS, digests
from meterline.llm.queries_quality import ACCEPTED, folds
from meterline.llm.quality import fit_and_score
from meterline.llm.secrets import WHOLE_RULES, redact, scan
from meterline.operators.joins import fits_broadcast

#: Up to so many ids of documents that go are broadcast.
BROADCAST_IDS = 1_000_000
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
#: Near copies: shingles of five words, 0.8 alike.
NEAR_COPIES = jaccard.Measure(words=5, percent=80)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier, fitted on the labelled ones among them, accepts.

    Every row goes or stays by its own text, whatever other rows have its id or have none.
    """
    _, learn, calibrate = folds()
    hashed = docs.withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    with small_batches(spark):
        scored = fit_and_score(docs, read_table(spark, sf_dir, "labels"), "quality", learn, calibrate)
        rejected = scored.where(F.col("score") < ACCEPTED).select("doc_id", "text_hash").distinct()
        return _without(hashed, rejected, "doc_id", "text_hash").select(*DOCUMENT)


def _without(docs: DataFrame, keys: DataFrame, *names: str) -> DataFrame:
    """The documents with other keys; only a list of keys that is measured to be short is broadcast."""
    gone = stored(keys.select(*(F.col(n).alias(f"_gone_{n}") for n in names)), "gone")
    side = F.broadcast(gone) if fits_broadcast(gone, BROADCAST_IDS) else gone
    return docs.join(side, [docs[n].eqNullSafe(F.col(f"_gone_{n}")) for n in names], "left_anti")


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, that with the smallest id; repeated rows once.

    Ids name documents only where each row has one of its own. Elsewhere rows are
    numbered first and compared as rows, so that different texts with one id, or
    without any, all stay, and rows without an id go only as copies of others.
    """
    unclear = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL")
    if unclear.isEmpty():
        linked = stored(jaccard.link(docs, NEAR_COPIES).select("doc_id", "component_id"), "linked")
        return _without(docs, linked.where("doc_id <> component_id"), "doc_id").select(*DOCUMENT)
    rows = stored(docs.select(*DOCUMENT, F.monotonically_increasing_id().alias("row")), "rows")
    linked = jaccard.link(rows, NEAR_COPIES, id_col="row").withColumnRenamed("doc_id", "row")
    described = rows.select("row", "doc_id", F.xxhash64(*DOCUMENT).alias("same")).join(linked, "row")
    alike = F.when(F.col("n_shingles") > 0, F.struct(F.lit(None).cast("bigint").alias("id"), F.col("component_id").alias("group")))
    alike = alike.otherwise(F.struct(F.col("doc_id").alias("id"), F.col("same").alias("group")))  # texts without words: repeated rows alone
    described = stored(described.withColumn("alike", alike), "described")
    kept = described.groupBy("alike").agg(F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("row"))
    gone = described.select("row").join(kept.select("row"), "row", "left_anti")
    return _without(rows, gone, "row").select(*DOCUMENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no item of the benchmark; a row goes by its own text, whatever else has its id."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark")).select(*DOCUMENT)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets (of private keys the body too) replaced by a mark; the length follows the text, which stays null where it was."""
    found = scan(docs, WHOLE_RULES, keep=DOCUMENT[1:]).withColumn("clean", redact(F.col("text"), F.col("spans")))
    changed = F.size("spans") > 0
    return found.select(
        "doc_id",
        F.when(changed, F.col("clean")).otherwise(F.col("kept.text")).alias("text"),
        "kept.lang",
        "kept.source",
        F.when(changed, F.length("clean").cast("long")).otherwise(F.col("kept.n_chars")).alias("n_chars"),
    )


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's number of token ids, and digests of the ids and of what they decode to.

    The session's batches stay limited, as the caller runs the job.
    """
    limit_batches(spark)
    return digests(encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, with_decoded=True))
