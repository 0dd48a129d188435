"""N-gram Jaccard join: prefix filters under several orders of the tokens, then exact comparison.

A document's tokens are its distinct shingles. Under any order that holds for
all documents, two sets as alike as asked share a token among the first few of
each (the prefix). Orders here put tokens that are rare in the corpus first,
by a table of counts whose size is fixed, and break ties by a different hash
each. Pairs come from shared prefix tokens of the first order and must share
prefix tokens under every other order too, before their sets are compared.

Before texts are sent to be compared, pairs go whose histograms say enough: a
set's tokens are counted in a few buckets, and two sets differ in at least as
many tokens as their counts do, so no link is lost by that.

Groups are not expanded into pairs. Equal sets are one class. First, of all
documents with a common prefix token, each is compared with the smallest and
the largest id among them; documents that this links form components. Then
only pairs of different components that share a prefix token are compared.
Every linked pair either lies within a component of the first step or is
compared in the second, so no link between components is lost.

Defined results: null, empty and white texts have no shingle and link with
nothing; a text with fewer words than a shingle is one shingle; rows without
an id are left out of the links and keep a null component; rows with equal ids
are one document that has all their links; columns other than those named are
left behind. Ids must be whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.bpe import in_portions
from meterline.llm.common import block_count, kept_by_worker, small_batches, stored, texts
from meterline.llm.components import components
from meterline.llm.packing import numbers, packed, read, unpacked
from meterline.operators.joins import fits_broadcast

#: The corpus counts are kept for so many groups of tokens; groups are summed in slices.
SKETCH_BITS, SLICE_BITS = 22, 16
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: A set's histogram has so many buckets, and counts up to what a byte holds.
BUCKETS, MOST = 256, 127
#: Salts of the orders that break ties; the first one finds the pairs.
ORDERS = (0x0, 0x5851F42D4C957F2D, 0x14057B7EF767814F)
#: So many documents are compared with one other in a task.
MEMBERS_A_TASK = 256
#: Up to so many, the places that texts go to, ids of candidates and members of components are broadcast.
BROADCAST_ROUTES = 800_000
REMEMBERED = 100_000
#: A task packs its prefix tokens whenever it has so many; a range of tokens is made for so much input.
FLUSHED_TOKENS, RANGE_BYTES = 1_000_000, 8 << 20


@dataclass(frozen=True)
class Measure:
    """Words a shingle, and the least similarity in hundredths."""

    words: int = 4
    percent: int = 85


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = number = xxhash.xxh3_64_intdigest(word)
        return number


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Shingler:
    """Whole texts to sorted distinct shingle hashes."""

    def __init__(self, words: int):
        self.words, self.hashes = words, _WordHashes()

    def __call__(self, text: str) -> np.ndarray:
        parts = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
        n = len(parts)
        if not n:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(self.hashes.__getitem__, parts), dtype=np.uint64, count=n)
        size = min(n, self.words)
        with np.errstate(over="ignore"):
            total = h[: n - size + 1] + np.uint64(size)
            for k in range(1, size):
                total = _mixed(total * MULTIPLIER) + h[k : n - size + 1 + k]
            return np.unique(_mixed(total * MULTIPLIER))


def worker_shingler(words: int) -> Shingler:
    return kept_by_worker(("shingler", words), lambda: Shingler(words))


class Orders:
    """The global orders: rarer groups of tokens first, then by a salted hash."""

    def __init__(self, levels: np.ndarray):
        self.levels = levels

    @staticmethod
    def levels_of(counts: np.ndarray) -> np.ndarray:
        return np.log2(np.maximum(counts, 1)).astype(np.uint8)

    def prefix(self, tokens: np.ndarray, order: int, percent: int) -> np.ndarray:
        """The first tokens in this order, of which sets as alike as asked share one."""
        n = len(tokens)
        size = min(n, n - -(-percent * n // 100) + 1)
        with np.errstate(over="ignore"):
            rank = _mixed((tokens ^ np.uint64(ORDERS[order])) * MULTIPLIER) >> np.uint64(6)
        rank |= self.levels[tokens >> np.uint64(64 - SKETCH_BITS)].astype(np.uint64) << np.uint64(58)
        first = np.argpartition(rank, size - 1)[:size]
        return tokens[first[np.argsort(rank[first])]]


def _signature(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share."""
    data = tokens.tobytes()
    wide = xxhash.xxh3_128_intdigest(data)
    return (wide >> 64) - (1 << 63), (wide & ((1 << 64) - 1)) - (1 << 63)


def _histogram(tokens: np.ndarray) -> np.ndarray:
    return np.minimum(np.bincount((tokens % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS), MOST).astype(np.int8)


def _describe(docs: DataFrame, measure: Measure) -> DataFrame:
    """A row per document with its set's size, signature and histogram; rows per task with its part of the corpus counts."""
    layout = "doc_id bigint, n bigint, high bigint, low bigint, buckets array<tinyint>, slice int, counts binary"
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("high", pa.int64()), ("low", pa.int64()), ("buckets", pa.list_(pa.int8())), ("slice", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, counts = worker_shingler(measure.words), np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for batch in batches:
            for part in in_portions(batch, "text"):
                sets = [shingle(text.as_py()) for text in part.column("text")]
                groups, times = np.unique(np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS), return_counts=True)
                counts[groups] += times.astype(counts.dtype)
                high, low = zip(*map(_signature, sets))
                none = [None] * len(sets)
                columns = [part.column("doc_id"), list(map(len, sets)), high, low, list(map(_histogram, sets)), none, none]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)
        if counts.any():
            slices = counts.reshape(-1, 1 << SLICE_BITS)
            none = [None] * len(slices)
            columns = [none, none, none, none, none, range(len(slices)), list(map(numbers, slices))]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)

    return docs.mapInArrow(run, layout)


def _corpus_levels(described: DataFrame) -> np.ndarray:
    """How frequent each group of tokens is, a byte each: 2 to ``SKETCH_BITS`` of them, whatever the corpus."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, number = np.zeros(1 << SLICE_BITS, dtype=np.uint64), None
        for batch in batches:
            number = batch.column("slice")[:1]
            for part in batch.column("counts"):
                total += read(part.as_py())
        yield pa.RecordBatch.from_arrays([number, pa.array([Orders.levels_of(total).tobytes()], pa.binary())], ["slice", "levels"])

    parts = described.where("slice IS NOT NULL").select("slice", "counts").groupBy("slice").applyInArrow(add, "slice int, levels binary")
    levels = np.zeros(1 << SKETCH_BITS, dtype=np.uint8)
    for row in parts.collect():
        levels[row.slice << SLICE_BITS : (row.slice + 1) << SLICE_BITS] = np.frombuffer(row.levels, dtype=np.uint8)
    return levels


def _prefixes(docs: DataFrame, shared, measure: Measure, ranges: int) -> DataFrame:
    """The prefix tokens of the first order with their documents and sizes, packed by ranges of tokens.

    Of equal sets in a task only one is taken.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, orders, seen = worker_shingler(measure.words), Orders(shared.value), set()
        borders = np.array([(k << 64) // ranges for k in range(1, ranges)], dtype=np.uint64)
        held: list[tuple[np.ndarray, int, int]] = []

        def flushed() -> pa.RecordBatch:
            sizes = [len(x) for x, _, _ in held]
            nodes, ns = (np.array([h[k] for h in held], dtype=np.int64) for k in (1, 2))
            token = np.concatenate([x for x, _, _ in held])
            held.clear()
            order = np.argsort(token, kind="stable")
            token = token[order]
            # Whose a token is and its place take 32 bits each; ids are looked up range by range, so that little lies in memory at once.
            at = np.concatenate([np.arange(size, dtype=np.int32) for size in sizes])[order]
            whose = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order]
            del order
            cuts = [0, *np.searchsorted(token, borders).tolist(), len(token)]
            spans = [(k, slice(a, b)) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
            rows = [(k, packed(token[s]), nodes[whose[s]].tobytes(), numbers(ns[whose[s]]), numbers(at[s])) for k, s in spans]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 4))], PACKED)

        count = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                tokens = shingle(text.as_py())
                sign = _signature(tokens)
                if len(tokens) and sign not in seen:
                    seen.add(sign)
                    held.append((orders.prefix(tokens, 0, measure.percent), doc_id, len(tokens)))
                    count += len(held[-1][0])
                    if count >= FLUSHED_TOKENS:
                        yield flushed()
                        count = 0
        if held:
            yield flushed()

    return docs.mapInArrow(run, "range int, tokens binary, nodes binary, sizes binary, places binary")


PACKED = ["range", "tokens", "nodes", "sizes", "places"]


def _meeting(table: pa.Table) -> pa.Table:
    """Of a range of tokens the rows whose token more than one document has, with the smallest and largest of these."""
    token = np.concatenate([unpacked(x.as_py()) for x in table.column("tokens")])
    node = np.concatenate([np.frombuffer(x.as_py(), dtype=np.int64) for x in table.column("nodes")])
    n, at = (np.concatenate([read(x.as_py()) for x in table.column(c)]).astype(np.int64) for c in ("sizes", "places"))
    order = np.lexsort((node, token))
    token, node, n, at = token[order], node[order], n[order], at[order]
    first = np.concatenate([[True], token[1:] != token[:-1]])
    begins = np.flatnonzero(first)
    ends = np.append(begins[1:], len(token)) - 1
    group = np.cumsum(first) - 1
    low, high = begins[group], ends[group]
    shared = node[low] < node[high]
    columns = [token.view(np.int64), node, n, at, node[low], n[low], at[low], node[high], n[high], at[high]]
    return pa.table(dict(zip(MEETING, (pa.array(c[shared]) for c in columns))))


MEETING = ("token", "node", "n", "at", "low", "low_n", "low_at", "high", "high_n", "high_at")


def _can_link(n: Column, at: Column, other_n: Column, other_at: Column, percent: int) -> Column:
    """Whether sets of these sizes can be alike enough if this token is the first that they share in the order.

    Then they share nothing before it, so at most what is left of the smaller rest.
    """
    needed = F.ceil((n + other_n) * percent / (100 + percent) - 1e-9)
    return (F.least(n, other_n) * 100 >= F.greatest(n, other_n) * percent) & (F.least(n - at, other_n - other_at) >= needed)


def _small(rows: DataFrame) -> DataFrame:
    """The rows, to be broadcast if they are measured to be few."""
    return F.broadcast(rows) if fits_broadcast(rows, BROADCAST_ROUTES) else rows


def _near(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (hub, member) whose histograms do not differ in more tokens than linked sets may."""

    pairs = stored(pairs, "candidates")
    ends = pairs.select(F.explode(F.array("hub", "member")).alias("doc_id")).distinct()
    some = sets.join(_small(ends), "doc_id", "left_semi")

    def side(end: str) -> DataFrame:
        return some.select(F.col("doc_id").alias(end), F.col("n").alias(f"{end}_n"), F.col("buckets").alias(f"{end}_buckets"))

    both = pairs.join(side("hub"), "hub").join(side("member"), "member")
    differences = F.zip_with("hub_buckets", "member_buckets", lambda x, y: F.abs(x.cast("int") - y.cast("int")))
    apart = F.aggregate(differences, F.lit(0), lambda total, x: total + x)
    # Sets of a and b tokens that share s of them differ in a + b - 2 s; linked ones have s >= percent * (a + b) / (100 + percent).
    near = both.where(apart * (100 + percent) <= (F.col("hub_n") + F.col("member_n")) * (100 - percent))
    return near.select("hub", "member").distinct()  # an id may have several sets


def _verified(docs: DataFrame, pairs: DataFrame, shared, measure: Measure) -> DataFrame:
    """The links among ``pairs`` (hub, member): prefixes of all orders meet, and the sets are alike enough.

    Texts go to tasks that hold a hub and some of its members.
    """
    dealt = pairs.select("hub", "member", F.pmod(F.xxhash64("member"), F.col("parts")).alias("part"))
    hubs = dealt.select("hub", "part").distinct().select(F.col("hub").alias("doc_id"), "hub", "part", F.lit(True).alias("is_hub"))
    routes = hubs.unionByName(dealt.select(F.col("member").alias("doc_id"), "hub", "part", F.lit(False).alias("is_hub")))
    rows = docs.join(_small(routes), "doc_id").select("hub", "part", "is_hub", "doc_id", "text")
    percent = measure.percent

    def compare(table: pa.Table) -> pa.Table:
        shingle, orders = worker_shingler(measure.words), Orders(shared.value)
        flags = np.array(table.column("is_hub").to_pylist(), dtype=bool)
        ids, hub_id = table.column("doc_id").to_pylist(), table.column("hub")[0].as_py()
        hub_sets, found = [shingle(table.column("text")[int(k)].as_py()) for k in np.flatnonzero(flags)], []
        prefixes = [[orders.prefix(h, o, percent) for o in range(1, len(ORDERS))] for h in hub_sets]
        for k in np.flatnonzero(~flags):
            tokens = shingle(table.column("text")[int(k)].as_py())
            for hub, firsts in zip(hub_sets, prefixes):
                if 100 * min(len(hub), len(tokens)) < percent * max(len(hub), len(tokens)):
                    continue
                if not all(np.isin(orders.prefix(tokens, o, percent), first).any() for o, first in enumerate(firsts, 1)):
                    continue
                shared_n = len(np.intersect1d(hub, tokens, assume_unique=True))
                if 100 * shared_n >= percent * (len(hub) + len(tokens) - shared_n):
                    found.append(ids[k])
                    break
        return pa.table({"a": pa.array([hub_id] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    return rows.groupBy("hub", "part").applyInArrow(compare, "a bigint, b bigint")


def link(docs: DataFrame, measure: Measure = Measure(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, the smallest id reachable by links, for every row."""
    with small_batches(docs.sparkSession):
        return _linked(texts(docs, id_col, text_col), measure, block_count(docs, RANGE_BYTES))


def _linked(every: DataFrame, measure: Measure, ranges: int) -> DataFrame:
    source = every.where("doc_id IS NOT NULL")
    described = stored(_describe(every.select(F.col("doc_id").cast("bigint"), "text"), measure), "sets")
    sets = described.where("slice IS NULL").drop("slice", "counts")
    whole = sets.where("n > 0 AND doc_id IS NOT NULL")
    shared = every.sparkSession.sparkContext.broadcast(_corpus_levels(described))
    # equal sets, and rows with equal ids, are linked to begin with
    classes = whole.groupBy("high", "low", "n").agg(F.min("doc_id").alias("first"))
    known = whole.join(classes, ["high", "low", "n"]).select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    known = stored(known.where("a <> b").distinct(), "equal-sets")
    placed = _prefixes(source.select(F.col("doc_id").cast("bigint"), "text"), shared, measure, ranges)
    together = stored(placed.groupBy("range").applyInArrow(_meeting, ", ".join(f"{c} bigint" for c in MEETING)), "meeting")
    ends = [F.struct(F.col(e).alias("node"), F.col(f"{e}_n").alias("n"), F.col(f"{e}_at").alias("at")) for e in ("low", "high")]
    first = together.select("node", "n", "at", F.explode(F.array(*ends)).alias("hub")).where(F.col("hub.node") != F.col("node"))
    first = first.where(_can_link(F.col("n"), F.col("at"), F.col("hub.n"), F.col("hub.at"), measure.percent))
    first = first.select(F.col("hub.node").alias("hub"), F.col("node").alias("member")).distinct()
    first = stored(_without(_near(first, whole, measure.percent), known), "first-pairs")
    links = known.unionByName(stored(_verified(source, _parts(first), shared, measure), "links"))
    member_of = _small(components(links))
    tokens = together.select("token", "node", "n", "at").join(member_of, "node", "left").withColumn("c", F.coalesce("component", "node"))
    open_tokens = tokens.groupBy("token").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x < y").select("token")
    left = stored(tokens.join(open_tokens, "token").select("token", "node", "n", "at", "c"), "open")
    right = left.select("token", F.col("node").alias("other"), F.col("n").alias("other_n"), F.col("at").alias("other_at"), F.col("c").alias("other_c"))
    apart = (F.col("c") < F.col("other_c")) & _can_link(F.col("n"), F.col("at"), F.col("other_n"), F.col("other_at"), measure.percent)
    second = left.join(right, "token").where(apart).select(F.col("node").alias("hub"), F.col("other").alias("member")).distinct()
    second = stored(_near(second, whole, measure.percent), "second-pairs")
    links = links.unionByName(stored(_verified(source, _parts(second), shared, measure), "links"))
    final = components(links)
    shared.unpersist()
    sizes = sets.select("doc_id", F.col("n").alias("n_shingles"))
    return sizes.join(final, sizes["doc_id"] == final["node"], "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _without(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs whose sets are not known to be equal already."""
    first = known.select(F.col("a").alias("node"), F.col("b").alias("class"))
    sides = pairs.join(first.withColumnsRenamed({"node": "hub", "class": "hub_class"}), "hub", "left")
    sides = sides.join(first.withColumnsRenamed({"node": "member", "class": "member_class"}), "member", "left")
    return sides.where(F.coalesce("hub_class", "hub") != F.coalesce("member_class", "member")).select("hub", "member")


def _parts(pairs: DataFrame) -> DataFrame:
    """In how many parts the members of each hub are compared."""
    many = pairs.groupBy("hub").agg(F.ceil(F.count("*") / MEMBERS_A_TASK).alias("parts"))
    return pairs.join(many, "hub")
