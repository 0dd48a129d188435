"""The query of the document fingerprints over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import read_table
from meterline.llm.merkle import edit_with_next, edited_branches, likeness


def op8_merkle(spark: SparkSession, folder: str) -> DataFrame:
    mark, edited, following = F.col("fingerprint"), F.col("edited_fingerprint"), F.col("next_fingerprint")
    return edit_with_next(read_table(spark, folder, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(mark, edited).alias("near_edited"),
        likeness(mark, following).alias("near_next"),
        F.size(edited_branches(mark, edited)).alias("n_edited_branches"),
    )


QUERIES = {"op8_merkle": op8_merkle}
ORACLE = {
    "op8_merkle": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
    coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id), first_value(coalesce(text, '')) OVER (ORDER BY doc_id)) AS following
  FROM documents
),
e AS (SELECT *, left(text, n - n // 4) || left(following, n // 4) AS edited FROM d),
t AS (SELECT text FROM e UNION SELECT edited FROM e),
leaves AS (
  SELECT text, list_transform(regexp_extract_all(text, '[^\n.!?]{0,160}[\n.!?]+|[^\n.!?]{1,160}'), lambda p: left(md5(p), 12)) AS leaves FROM t
),
trees AS (
  SELECT text, list_distinct(leaves) AS leaves,
    rtrim(array_to_string(list_transform(leaves, lambda x: x || CASE WHEN starts_with(x, '0') THEN ';' ELSE ',' END), ''), ',;') AS tree
  FROM leaves
),
marks AS (
  SELECT text, leaves, list_filter(string_split(tree, ';'), lambda s: s <> '') AS sections,
    sha256(array_to_string(list_transform(string_split(tree, ';'), lambda s: md5(s)), '')) || ':' || tree AS mark
  FROM trees
),
pairs AS (
  SELECT doc_id, n, edited, a.mark AS a, b.mark AS b, c.mark AS c, a.leaves AS la, b.leaves AS lb, c.leaves AS lc, a.sections AS sa, b.sections AS sb
  FROM e JOIN marks a ON a.text = e.text JOIN marks b ON b.text = e.edited JOIN marks c ON c.text = e.following
)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, a AS fingerprint, b AS edited_fingerprint,
  CASE WHEN a = b THEN 1.0 ELSE 2.0 * len(list_intersect(la, lb)) / greatest(len(la) + len(lb), 1) END::DOUBLE AS near_edited,
  CASE WHEN a = c THEN 1.0 ELSE 2.0 * len(list_intersect(la, lc)) / greatest(len(la) + len(lc), 1) END::DOUBLE AS near_next,
  len(list_distinct(list_filter(sa, lambda s: NOT list_contains(sb, s))))::INTEGER AS n_edited_branches
FROM pairs
"""
}
