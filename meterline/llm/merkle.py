"""Document fingerprints: Merkle trees over paragraphs and sections.

The leaves are digests of paragraphs: a line or sentence with its end, long
ones cut. A section ends after a leaf whose digest begins with ``0``, so an
edit moves no section border but its own. A section's digest is taken over its
leaves, the root over the sections. A fingerprint is written
``root:leaf,leaf;leaf,...`` with ``;`` between sections: equal roots mean equal
texts, sections found in one tree only are the branches with edits, and within
them the leaves found in one only are the edited places.

Defined results: a null or empty text has a root and no leaf; it is wholly
like another empty text and unlike any other. Everything is a DataFrame
operation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import block_count, stored, texts

#: A paragraph ends after these characters, or before it gets longer than this.
PARAGRAPH = r"[^\n.!?]{0,160}[\n.!?]+|[^\n.!?]{1,160}"
LEAF_DIGITS = 12


def leaves(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), lambda p: F.substring(F.md5(p), 1, LEAF_DIGITS))


def fingerprint(text: Column) -> Column:
    """The written tree of a text (not null)."""
    marked = F.transform(leaves(text), lambda leaf: F.concat(leaf, F.when(leaf.startswith("0"), ";").otherwise(",")))
    return _rooted(F.rtrim(F.array_join(marked, ""), F.lit(",;")))


def _rooted(tree: Column) -> Column:
    digests = F.transform(F.split(tree, ";", -1), lambda section: F.md5(section))
    return F.concat(F.sha2(F.array_join(digests, "").cast("binary"), 256), F.lit(":"), tree)


def root(mark: Column) -> Column:
    return F.substring_index(mark, ":", 1)


def sections(mark: Column) -> Column:
    return F.filter(F.split(F.substring_index(mark, ":", -1), ";", -1), lambda s: s != "")


def edited_branches(mark: Column, other: Column) -> Column:
    """The sections of a tree that the other tree does not have: where the edits are."""
    return F.array_except(sections(mark), sections(other))


def likeness(mark: Column, other: Column) -> Column:
    """1 for equal roots; else twice the shared distinct leaves by those of both trees."""

    def distinct(x: Column) -> Column:
        return F.array_distinct(F.filter(F.split(F.substring_index(x, ":", -1), "[,;]", -1), lambda leaf: leaf != ""))

    a, b = distinct(mark), distinct(other)
    both = F.size(a) + F.size(b)
    shared = 2.0 * F.size(F.array_intersect(a, b)) / F.greatest(both, F.lit(1))
    return F.when(root(mark) == root(other), 1.0).otherwise(shared)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``fingerprint`` of each whole text."""
    return texts(docs, id_col, text_col).select("doc_id", fingerprint(F.col("text")).alias("fingerprint"))


def _in_order(keys: DataFrame, bytes_a_range: int) -> DataFrame:
    """``next_key`` beside each key, in ascending order of the id, the first following the last.

    Keys are put into ranges; each range is ordered by itself, and its last
    row is given the first of the next range. Only a row per range meets in one task.
    The ranged keys are written once: each range exchange draws its own borders.
    """
    ranged = keys.repartitionByRange(block_count(keys, bytes_a_range), "doc_id", "text_hash").withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "in_order")
    heads = ranged.groupBy("part").agg(F.min(F.struct("doc_id", "text_hash", "key")).alias("head"))
    along = Window.orderBy("part")
    over_all = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("part", F.coalesce(F.lead("head").over(along), F.first("head").over(over_all)).alias("next_head"))
    within = Window.partitionBy("part").orderBy("doc_id", "text_hash", "key")
    follows = ranged.withColumn("follower", F.lead("key").over(within)).join(heads, "part")
    return follows.select("key", "n_chars", "copies", F.coalesce("follower", F.col("next_head")["key"]).alias("next_key"))


def edit_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bytes_a_range: int = 64 << 20) -> DataFrame:
    """Each text and its fingerprint, the text with its last quarter replaced by the head of the next document, and the next one's fingerprint.

    Rows equal in id and text count as one document when the next is looked
    for, and each has a row in the result; rows with equal ids and different
    texts follow each other by a hash of the text; those without an id come
    first. A single document is its own next. There are as many followers as
    documents, so if every document is one, each is one once; a document that
    follows none stops the query.
    """
    source = texts(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.hex("text_hash"), F.length("text"))
    # Both branches below read the same columns of this frame, so that its exchange is written once and reused.
    whole = source.withColumn("key", key).groupBy("key").agg(F.first(F.struct("doc_id", "text")).alias("row"))
    keys = source.select("doc_id", "text_hash", key.alias("key"), F.length("text").cast("long").alias("n_chars"))
    keys = keys.groupBy("doc_id", "text_hash", "key", "n_chars").agg(F.count("*").alias("copies"))
    order = _in_order(keys, bytes_a_range)
    before = order.select(F.col("next_key").alias("key"), F.col("key").alias("previous"), F.col("n_chars").alias("previous_n"))
    own = order.select("key", "copies")
    followed = F.when(F.col("previous").isNull(), F.raise_error(F.concat(F.lit("follows no document: "), "key"))).otherwise(F.col("previous"))
    quarter = F.floor(F.col("previous_n") / 4).cast("int")
    text = F.col("row.text")
    heads = whole.join(before, "key", "left").select(followed.alias("key"), F.substring(text, F.lit(1), quarter).alias("head"), fingerprint(text).alias("next_fingerprint"))
    n_chars = F.length("text").cast("long")
    kept = F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - F.floor(F.col("n_chars") / 4)).cast("int"))
    edited = whole.join(heads, "key").join(own, "key").select("row.doc_id", "row.text", "head", "next_fingerprint", "copies").withColumn("n_chars", n_chars)
    edited = edited.withColumn("edited", F.concat(kept, "head")).withColumns({"fingerprint": fingerprint(F.col("text")), "edited_fingerprint": fingerprint(F.col("edited"))})
    return edited.select("doc_id", "n_chars", "text", "edited", "fingerprint", "edited_fingerprint", "next_fingerprint", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy")).drop("copy")
