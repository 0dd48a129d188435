"""A trie of conversation prefixes, aggregated by ROLLUP over positional turn columns.

Every turn gets an id that stands for its role and text. A conversation is laid
out in blocks of ``WIDTH`` positional columns, and one ``GROUP BY block, prior,
ROLLUP (t1, ..)`` makes all nodes of all depths at once; ``grouping_id`` tells
how many columns a row was grouped by. ``prior`` is the key of the node that the
block hangs from: the sum of one 96-bit number for each earlier turn and its
place, so it can be made by a running sum, and conversations of any length take
part in the same ROLLUP, however many blocks they have.

A node is named by its smallest member. The nodes with one name are a chain down
to that conversation's end, and chains hang from chains. What a subtree sums to
is added up over the chains by pointer doubling, in as many rounds as the
logarithm of how deep chains hang from chains, and given back to the nodes of a
chain by another running sum.

Defined results: a null role or text is an empty one; turns of one number are
in the order of role and text; repeated rows are repeated turns; a row without
a conversation's id belongs to none and takes no part; an empty table has no
conversation and no node, not even a root; texts of any length count by a
digest (MD5 of role and text, told apart by the role's length); further columns
are left behind. Nothing is gathered by conversation, node or text: the ids of
a node's members are hashed as they stream by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import stored
from meterline.operators.ordered import running_sum_before
from meterline.session import ship_package, shuffle_partitions

#: Positional columns of a block.
WIDTH = 8
SLOTS = [f"t{k}" for k in range(1, WIDTH + 1)]
KEY = "decimal(38,0)"
#: Leaves take the digits below this in a sum of saved bytes and leaves.
LEAVES = 10**15
#: So many bytes of ids are joined before they are handed to the hash.
IDS_A_PIECE = 1 << 16
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    """Names a turn by its content; ends with the bytes of its text."""
    told_apart = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.concat_ws(":", F.md5(told_apart.cast("binary")), F.octet_length(text).cast("string"))


def numbered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id``, ``place`` (from 1) and ``turn_id`` of every turn; a conversation may hold any share of the rows."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    rows = turns.filter(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"), F.lit(1).cast("long").alias("one"))
    counted = running_sum_before(rows, ["conv_id"], ["turn", "role", "text"], "one", "before")
    return counted.select("conv_id", (F.col("before") + 1).alias("place"), turn_id(F.col("role"), F.col("text")).alias("turn_id"))


def _weight(turn: Column, place: Column) -> Column:
    """A number below 2 to the 96th for a turn at its place; 0 for no turn."""
    first, second = F.xxhash64(turn, place), F.xxhash64(place, turn, F.lit("second"))
    unsigned = first.cast("decimal(20,0)") + F.when(first < 0, F.lit(Decimal(2**64))).otherwise(F.lit(0).cast("decimal(20,0)"))
    high = second.bitwiseAND(F.lit(2**32 - 1)).cast("decimal(10,0)") * F.lit(Decimal(2**64))
    return F.when(turn.isNull(), F.lit(0)).otherwise(high + unsigned).cast(KEY)


def _weights() -> Column:
    total = F.lit(0).cast(KEY)
    for k, slot in enumerate(SLOTS):
        total = (total + _weight(F.col(slot), F.col("block") * WIDTH + k + 1)).cast(KEY)
    return total


def laid_out(turns: DataFrame, members: DataFrame) -> DataFrame:
    """A row for each block of a conversation: ``conv_id``, ``block``, ``t1``.., ``weight`` and ``prior``.

    A member without turns has one block without any.
    """
    marks = members.select("conv_id", F.lit(1).cast("long").alias("place"), F.lit(None).cast("string").alias("turn_id"))
    at = F.col("place") - 1
    slots = [F.max(F.when(at % WIDTH == k, F.col("turn_id"))).alias(slot) for k, slot in enumerate(SLOTS)]
    rows = turns.select("conv_id", "place", "turn_id").unionByName(marks)
    blocks = rows.groupBy("conv_id", F.floor(at / WIDTH).alias("block")).agg(*slots)
    return running_sum_before(blocks.withColumn("weight", _weights()), ["conv_id"], ["block"], "weight", "prior").withColumn("prior", F.col("prior").cast(KEY))


def rolled_up(blocks: DataFrame) -> DataFrame:
    """All nodes: ``depth``, ``key``, ``parent_key``, ``conv_id`` (smallest member), ``n_convs``, ``last_bytes``."""
    columns = ", ".join(SLOTS)
    grouped = blocks.sparkSession.sql(
        f"SELECT block, prior, {columns}, bit_count(grouping_id()) AS left_out, count(*) AS n_convs, min(conv_id) AS conv_id FROM {{blocks}} GROUP BY block, prior, ROLLUP ({columns})",
        blocks=blocks.select("conv_id", "block", "prior", *SLOTS),
    )
    within = WIDTH - F.col("left_out")
    last = F.element_at(F.array(*SLOTS), F.greatest(within, F.lit(1)).cast("int"))
    nodes = grouped.withColumns({"within": within, "last": F.when(within > 0, last)})
    nodes = nodes.filter("last IS NOT NULL OR (within = 0 AND block = 0)")  # else a group of conversations that end before
    depth = F.col("block") * WIDTH + F.col("within")
    key = (F.col("prior") + _weights()).cast(KEY)
    return nodes.select(
        depth.alias("depth"),
        key.alias("key"),
        (key - _weight(F.col("last"), depth)).cast(KEY).alias("parent_key"),
        "conv_id",
        "n_convs",
        F.coalesce(F.substring_index("last", ":", -1).cast("long"), F.lit(0)).alias("last_bytes"),
    )


def _ends(blocks: DataFrame) -> DataFrame:
    """Where each conversation ends: ``conv_id``, ``depth``, ``key``."""
    filled = sum((F.col(slot).isNotNull().cast("int") for slot in SLOTS), F.lit(0))
    end = F.struct((F.col("block") * WIDTH + filled).alias("depth"), (F.col("prior") + F.col("weight")).cast(KEY).alias("key"))
    last = blocks.groupBy("conv_id").agg(F.max_by(end, "block").alias("end"))
    return last.select("conv_id", "end.depth", "end.key")


def _join_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one node's ids, in order, as pieces of text."""
    node, ids, held = None, [], 0

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"node": [node], "first": pa.array([ids[0]], pa.int64()), "ids": [",".join(map(str, ids))]})

    for batch in batches:
        for name, conv_id in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (name != node or held >= IDS_A_PIECE):
                yield piece()
                ids, held = [], 0
            node = name
            ids.append(conv_id)
            held += 20
    if ids:
        yield piece()


def _hash_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash a node, of its pieces in order."""
    node, state = None, None
    for batch in batches:
        for name, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if name == node:
                state.update(b",")
            else:
                if state:
                    yield pa.RecordBatch.from_pydict({"node": [node], "ends_sha256": [state.hexdigest()]})
                node, state = name, hashlib.sha256()
            state.update(ids.encode())
    if state:
        yield pa.RecordBatch.from_pydict({"node": [node], "ends_sha256": [state.hexdigest()]})


def _node_name() -> Column:
    return F.concat_ws(":", F.col("depth").cast("string"), F.col("key").cast("string"))


def ends_digests(ends: DataFrame) -> DataFrame:
    """``node`` and ``ends_sha256`` of the ids that end there.

    The ids are put in order by ranges of node and id, so those of a hot node are
    joined to pieces by many tasks; one task then hashes the node's pieces.
    """
    n = shuffle_partitions(ends.sparkSession)
    rows = ends.select(_node_name().alias("node"), "conv_id")
    ordered = rows.repartitionByRange(n, "node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = ordered.mapInArrow(_join_ids, "node string, first bigint, ids string")
    together = pieces.repartition(n, "node").sortWithinPartitions("node", "first")
    return together.mapInArrow(_hash_pieces, "node string, ends_sha256 string")


def _subtrees(chains: DataFrame) -> DataFrame:
    """``conv_id`` and ``total`` of each chain with all that hang from it, by pointer doubling."""
    state = stored(chains.select("conv_id", F.col("parent").alias("up"), F.col("own").alias("total")), "chains")
    while not state.filter("up IS NOT NULL").isEmpty():
        below = state.filter("up IS NOT NULL").groupBy("up").agg(F.sum("total").cast(KEY).alias("more"))
        above = state.filter("up IS NOT NULL").select(F.col("conv_id").alias("via"), F.col("up").alias("next"))
        summed = state.join(below.withColumnRenamed("up", "to"), F.col("conv_id") == F.col("to"), "left")
        moved = summed.join(above, F.col("up") == F.col("via"), "left")
        total = (F.col("total") + F.coalesce("more", F.lit(0))).cast(KEY)
        state = stored(moved.select("conv_id", F.col("next").alias("up"), total.alias("total")), "chains")
    return state.select("conv_id", "total")


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """Every node of the trie of these conversations' turns.

    ``turns``: ``conv_id``, ``place`` (1, 2, ..), ``turn_id``; ``members``: the
    ``conv_id`` of all conversations, those without turns too. Returns ``conv_id``
    (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves`` and ``saved_tokens`` of the subtree, and ``ends_sha256``.
    """
    ship_package(turns.sparkSession)
    blocks = stored(laid_out(turns, members), "blocks")
    nodes = stored(rolled_up(blocks), "nodes")
    saved = (F.col("n_convs") - 1).cast(KEY) * F.col("last_bytes")
    chains = nodes.groupBy("conv_id").agg(F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.min_by("parent_key", "depth").alias("above_key"), F.sum(saved).cast(KEY).alias("saved"))
    parents = nodes.select(F.col("conv_id").alias("parent"), F.col("depth").alias("at"), F.col("key").alias("above_key"))
    chains = stored(chains.withColumn("at", F.col("top") - 1).join(parents, ["at", "above_key"], "left").select("conv_id", "top", "bottom", "parent", "at", "saved"), "chain-ends")
    hanging = chains.filter("parent IS NOT NULL").groupBy("parent", "at").agg(F.count("*").alias("hanging"))
    ended = chains.join(hanging.select(F.col("parent").alias("conv_id"), F.col("at").alias("bottom"), "hanging"), ["conv_id", "bottom"], "left")
    leaf = F.when(F.col("hanging").isNull(), 1).otherwise(0)
    totals = _subtrees(ended.withColumn("own", (F.col("saved") * LEAVES + leaf).cast(KEY)))
    chains = stored(chains.join(totals, "conv_id"), "chain-totals")

    below = chains.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("conv_id"), F.col("at").alias("depth")).agg(F.count("*").alias("hanging"), F.sum("total").cast(KEY).alias("more"))
    rows = nodes.join(chains.drop("at", "saved"), "conv_id").join(below, ["conv_id", "depth"], "left")
    rows = rows.withColumn("n_children", F.coalesce("hanging", F.lit(0)) + (F.col("depth") < F.col("bottom")).cast("long"))
    own = saved * LEAVES + (F.col("n_children") == 0).cast("int") + F.coalesce("more", F.lit(0))
    rows = rows.select(
        "conv_id", "depth", F.when(F.col("depth") > F.col("top"), F.col("conv_id")).otherwise(F.col("parent")).alias("parent_conv_id"), "n_convs", "n_children", "total", own.cast(KEY).alias("amount"), _node_name().alias("node")
    )
    summed = running_sum_before(rows, ["conv_id"], ["depth"], "amount", "before")
    subtree = (F.col("total") - F.col("before")).cast(KEY)
    digests = ends_digests(_ends(blocks))
    return (
        summed.withColumns({"n_leaves": (subtree % LEAVES).cast("long"), "saved_tokens": F.floor(subtree / LEAVES).cast("long")})
        .join(digests, "node", "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))
    )
