"""The conversation trie against plain dictionaries, and the query against its SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from checks.compare import difference
from meterline.llm import prefix_trie as pt
from meterline.llm.common import stored
from meterline.llm.prefix_trie import numbered_turns, prefix_trie
from meterline.llm.queries_prefix_trie import ORACLE, op11_prefix_trie, rebuilt

SCHEMA = "conv_id long, turn long, role string, text string, place string, block int"
FOLDER = "/root/testdata/sf0.01"


def conversations(rows):
    found = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            found[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [turn[2:] for turn in sorted(turns)] for c, turns in found.items()}


def rebuilt_plainly(given):
    out = {}
    for c, turns in given.items():
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = given.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[x] for x in below) or 1
        saved[node] = sum(saved[x] for x in below) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
    rows = []
    for node, inside in members.items():
        ends = ",".join(str(c) for c in sorted(inside) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(inside), len(node), parent, len(inside), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def planted():
    rng = random.Random(11)
    rows = []
    for c in [*range(-12, 60), 990, 991]:
        n = rng.choice([1, 2, 3, 9, 17, 26])
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice("ab") if t > 1 else "hello") for t in range(n)]
    long = [(t, "user", rng.choice("xyz")) for t in range(70)]
    rows += [(c, *turn) for c in range(100, 140) for turn in long[: 70 - c % 3]]  # a group of copies
    rows += [(200, None, "user", "b"), (200, None, "user", "a"), (200, None, None, None), (200, 3, "é", "é\U0001f600"), (200, 3, "é", "é\U0001f600")]
    rows += [(None, 1, "user", "of no conversation"), (201, 1, "us", "er"), (202, 1, "use", "r"), (203, 5, "user", "word " * 100_000)]
    rng.shuffle(rows)
    return [(*r, "x", 3) for r in rows]


def test_rebuilt_trie_equals_dictionaries(spark):
    rows = planted()
    got = prefix_trie(*rebuilt(numbered_turns(spark.createDataFrame(rows, SCHEMA))))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rebuilt_plainly(conversations(rows)))


def test_given_conversations_and_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(pt, "IDS_A_PIECE", 60)
    rows = planted()
    turns = numbered_turns(spark.createDataFrame(rows, SCHEMA))
    empty = spark.createDataFrame([(7000,), (7001,)], "conv_id long")  # members without turns
    got = prefix_trie(turns, turns.select("conv_id").distinct().union(empty))
    assert sorted(map(tuple, got.collect()), key=str) == brute({**conversations(rows), 7000: [], 7001: []})


def test_columns_may_have_other_names(spark):
    rows = spark.createDataFrame([(1, 1, "u", "a"), (1, 2, "u", "b")], "text long, role int, turn string, conv_id string")
    turns = numbered_turns(rows, conv_col="text", turn_col="role", role_col="turn", text_col="conv_id")
    assert [tuple(r)[:2] for r in turns.orderBy("place").collect()] == [(1, 1), (1, 2)]


def test_empty_table(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(*rebuilt(numbered_turns(nothing))).count() == 0


@pytest.mark.parametrize("lengths", [[1], [8], [9], [16, 17, 8], [0, 1]])
def test_borders_of_blocks(spark, lengths):
    convs = {c: [("user", str(t % 3)) for t in range(n)] for c, n in enumerate(lengths)}
    rows = [(c, t, *turn, "", 0) for c, turns in convs.items() for t, turn in enumerate(turns)]
    turns = numbered_turns(spark.createDataFrame(rows, SCHEMA))
    got = prefix_trie(turns, spark.createDataFrame([(c,) for c in convs], "conv_id long"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(convs)


def test_query_equals_sql_and_dictionaries(spark):
    got = stored(op11_prefix_trie(spark, FOLDER), "trie")
    assert got.dtypes == [(c, "bigint") for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")] + [("ends_sha256", "string")]
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{FOLDER}/conversations.parquet'")
    assert difference(got.toPandas(), connection.execute(ORACLE["op11_prefix_trie"]).df()) is None
    rows = spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert sorted(map(tuple, got.collect()), key=str) == brute(rebuilt_plainly(conversations(rows)))


def test_one_rollup_makes_all_nodes(spark):
    turns = spark.createDataFrame([(1, p, str(p)) for p in range(1, 30)], "conv_id long, place long, turn_id string")
    nodes = pt.rolled_up(pt.laid_out(turns, turns.select("conv_id").distinct()))
    assert nodes.count() == 30 and nodes.agg(F.countDistinct("depth")).first()[0] == 30
    assert nodes._jdf.queryExecution().optimizedPlan().toString().count("Expand") == 1
