"""The query of the conversation trie over the given tables, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import fold, read_table, stored
from meterline.llm.prefix_trie import numbered_turns, prefix_trie

#: Conversations of one group of ids share the first turns of the group's first; at most one less than these.
GROUP, HEADS = 5, 9


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, members): each conversation led by the first turns of its group's first one.

    ``turns`` are numbered. A conversation takes as many of them as its id's
    checksum says and goes on with its own turns from there.
    """
    given = F.col("conv_id")
    members = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    members = members.withColumns({"heads": fold(given, HEADS), "base": given - given % GROUP})
    bases = members.select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    members = stored(members.join(bases, "base", "left").withColumn("taken", F.least("heads", F.coalesce("there", F.lit(0)))), "members")
    lent = turns.filter((given % GROUP == 0) & (F.col("place") < HEADS)).withColumnRenamed("conv_id", "base")
    heads = lent.join(members.select("base", "conv_id", "heads"), "base").filter("place <= heads").select("conv_id", "place", "turn_id")
    own = turns.join(members.select("conv_id", "heads", "taken"), "conv_id").filter("place > heads")
    own = own.select("conv_id", (F.col("place") - F.col("heads") + F.col("taken")).alias("place"), "turn_id")
    return heads.unionByName(own), members.select("conv_id")


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = stored(numbered_turns(read_table(spark, folder, "conversations")), "turns")
    return prefix_trie(*rebuilt(turns))


QUERIES = {"op11_prefix_trie": op11_prefix_trie}

ORACLE = {
    "op11_prefix_trie": """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, count(*) AS n FROM t GROUP BY conv_id),
m AS (
  SELECT conv_id, base, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
      lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, CAST(3988292384 AS BIGINT)) ELSE a >> 1 END))) % 9 AS heads
  FROM c
),
p AS (SELECT m.*, least(heads, coalesce(c.n, 0)) AS taken FROM m LEFT JOIN c ON c.conv_id = m.base),
r AS (
  SELECT p.conv_id, place, role, text FROM p JOIN t ON t.conv_id = p.base WHERE place <= heads
  UNION ALL
  SELECT p.conv_id, place - heads + taken, role, text FROM p JOIN t USING (conv_id) WHERE place > heads
),
paths AS (
  SELECT conv_id, 0 AS depth, '' AS path, 0 AS bytes FROM p
  UNION ALL
  SELECT conv_id, place, string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY place),
    octet_length(encode(text))
  FROM r
),
nodes AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM paths GROUP BY depth, path),
ends AS (
  SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS sha
  FROM (SELECT conv_id, max(path) AS path FROM paths GROUP BY conv_id) GROUP BY path
),
family AS (
  SELECT v.depth, v.path, count(*) FILTER (u.depth = v.depth + 1) AS n_children,
    sum((u.n_convs - 1) * u.bytes) AS saved_tokens,
    count(*) FILTER (NOT EXISTS (SELECT 1 FROM nodes w WHERE w.depth = u.depth + 1 AND w.path[1:32 * u.depth] = u.path)) AS n_leaves
  FROM nodes v JOIN nodes u ON starts_with(u.path, v.path) GROUP BY v.depth, v.path
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, o.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(sha, sha256('')) AS ends_sha256
FROM nodes n JOIN family USING (depth, path)
LEFT JOIN nodes o ON o.depth = n.depth - 1 AND o.path = n.path[1:32 * (n.depth - 1)]
LEFT JOIN ends ON ends.path = n.path
"""
}
