"""The query of the Jaccard join over the given tables, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterline.llm.common import read_table
from meterline.llm.jaccard import link


def op2_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return link(read_table(spark, folder, "documents"))


QUERIES = {"op2_jaccard": op2_jaccard}
ORACLE = {
    "op2_jaccard": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
),
ties AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN ties l ON l.a = r.other
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""
}
