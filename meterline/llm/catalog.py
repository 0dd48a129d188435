"""All queries of this subpackage and the SQL for those that SQL can express."""

from __future__ import annotations

from meterline.llm import queries_bpe, queries_decontaminate, queries_hard_negatives, queries_jaccard, queries_langid, queries_lm, queries_merkle, queries_pii, queries_planes, queries_prefix_trie, queries_quality, queries_secrets, queries_token_counts

_MODULES = (queries_decontaminate, queries_jaccard, queries_bpe, queries_planes, queries_langid, queries_quality, queries_secrets, queries_merkle, queries_pii, queries_lm, queries_prefix_trie, queries_hard_negatives, queries_token_counts)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
