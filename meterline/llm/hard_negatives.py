"""Hard negatives: rows of another label that score high, but not too high, against an anchor.

Scores are exact integer inner products of the components, scaled and rounded
down. All rows are packed once into blocks and stored. The anchors, a stated
query set, are packed into blocks of bounded size as well and go through the
tasks in waves: a wave is at most ``BLOCKS_A_WAVE`` anchor blocks, broadcast,
and every task multiplies it with one row block after the other (see
``residues``), keeping only the best rows of each anchor so far. No vector is
shuffled; the best of each task are merged by a window. One pass finds the
anchors' positives, a second one the negatives in the score window that each
positive sets.

Defined results: rows with a null label, a null vector, or any null or
non-finite component take no part; a row without an id takes part but follows
all others in a tie; rows with the same id are different rows, and an anchor
leaves out only itself; a vector that is shorter than another counts as filled
up with zeros; an anchor without positives, or whose positives' windows hold no
row, gives no row; an empty table gives an empty one; further columns are left
behind. Scores must lie within 62 bits: where the largest component cannot rule
out larger ones, an error says so.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import block_count, stored
from meterline.llm.residues import exact_product, primes_for, residues
from meterline.session import scratch_path, ship_package

ROWS_A_BLOCK, ANCHORS_A_BLOCK, BLOCKS_A_WAVE = 4096, 2048, 16
#: A block holds at most so many bytes of components; so many anchors meet a row block at a time.
BYTES_A_BLOCK, ANCHORS_AT_ONCE = 2 << 20, 256
BYTES_A_TASK = 4 << 20
LARGEST_SCORE = 1 << 62
#: Stands for no row; below every score.
NONE = np.iinfo(np.int64).min + 1
NO_ID = np.iinfo(np.int64).max

BLOCK = "block long, n int, width int, top long, ids binary, known binary, labels binary, components binary"
FOUND = "anchor long, anchor_id long, slot int, id long, score long, own boolean"
POSITIVES = "anchor long, anchor_id long, slot int, positive_id long, positive_score long"


def _packer(scale: float, most_rows: int):
    """Rows to blocks; a block's number is that of its task and its place there."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held, number = 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            vectors = batch.column("vector")
            flat = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            ends = np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False))
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "label")), np.split(flat, ends[:-1])):
                rows.append(row)
                held += 8 * len(row[2])
                if len(rows) == most_rows or held >= BYTES_A_BLOCK:
                    yield _block(number, rows)
                    rows, held, number = [], 0, number + 1
        if rows:
            yield _block(number, rows)

    return run


def _block(number: int, rows: list[tuple]) -> pa.RecordBatch:
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))  # ties within a block go by place
    width = max(len(v) for _, _, v in rows)
    matrix = np.zeros((len(rows), width))
    for k, (_, _, vector) in enumerate(rows):
        matrix[k, : len(vector)] = vector
    top = np.abs(matrix).max(initial=0)
    if top >= LARGEST_SCORE:
        raise OverflowError(f"a component of {top} leaves no room for its scores")
    small = next(t for t in (np.int16, np.int32, np.int64) if top <= np.iinfo(t).max)
    ids = np.array([NO_ID if i is None else i for i, _, _ in rows], dtype=np.int64)
    known = np.array([i is not None for i, _, _ in rows])
    labels = np.array([label for _, label, _ in rows], dtype=np.int64)
    row = dict(block=number, n=len(rows), width=width, top=int(top), ids=ids.tobytes(), known=known.tobytes(), labels=labels.tobytes(), components=matrix.astype(small).tobytes())
    return pa.RecordBatch.from_pylist([row], schema=_SCHEMA)


_SCHEMA = pa.schema([("block", pa.int64()), ("n", pa.int32()), ("width", pa.int32()), ("top", pa.int64()), *((c, pa.binary()) for c in ("ids", "known", "labels", "components"))])


class _Block:
    """A block's columns, the components filled up to the common width."""

    def __init__(self, row: dict, width: int):
        n, own = row["n"], row["width"]
        self.number, self.n = row["block"], n
        self.ids, self.labels = (np.frombuffer(row[c], dtype=np.int64) for c in ("ids", "labels"))
        self.known = np.frombuffer(row["known"], dtype=bool)
        size = len(row["components"]) // max(1, n * own)
        given = np.frombuffer(row["components"], dtype={2: np.int16, 4: np.int32, 8: np.int64}.get(size, np.int64))
        self.matrix = np.zeros((n, width), dtype=np.int64)
        self.matrix[:, :own] = given.reshape(n, own)


def best_first(scores: np.ndarray, wanted: np.ndarray, most: int, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores and places of each row's ``most`` best wanted columns, ties by place; NONE fills up.

    Score and place go into one number where 63 bits hold both, so that one sort of numbers does it.
    """
    n = scores.shape[1]
    bits = max(1, (n - 1).bit_length())
    most = min(most, n)
    if bound << (bits + 1) < 1 << 62:
        keys = np.where(wanted, (scores << bits) | ((1 << bits) - 1 - np.arange(n)), np.iinfo(np.int64).min)
        if most < n:
            keys = np.partition(keys, n - most, axis=1)[:, n - most :]
        keys.sort(axis=1)
        keys = keys[:, ::-1]
        places = (1 << bits) - 1 - (keys & ((1 << bits) - 1))
        missing = keys == np.iinfo(np.int64).min
        return np.where(missing, NONE, keys >> bits), np.where(missing, 0, places)
    held = np.where(wanted, scores, NONE)
    places = np.argsort(-held, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(held, places, axis=1), places


class _Best:
    """The best ``most`` rows for each of several searches so far, as scores, ids and marks."""

    def __init__(self, searches: int, most: int):
        self.scores = np.full((searches, most), NONE, dtype=np.int64)
        self.ids = np.full((searches, most), NO_ID, dtype=np.int64)
        self.known = np.zeros((searches, most), dtype=bool)
        self.own = np.zeros((searches, most), dtype=bool)

    def merge(self, at: slice, scores: np.ndarray, ids: np.ndarray, known: np.ndarray, own: np.ndarray | None = None) -> None:
        most = self.scores.shape[1]
        columns = [np.concatenate(pair, axis=1) for pair in ((self.scores[at], scores), (self.ids[at], ids), (self.known[at], known))]
        columns.append(np.concatenate([self.own[at], np.zeros_like(known) if own is None else own], axis=1))
        order = np.lexsort((columns[1], ~columns[2], -columns[0]), axis=-1)[:, :most]
        for kept, column in zip((self.scores, self.ids, self.known, self.own), columns):
            kept[at] = np.take_along_axis(column, order, axis=1)

    def rows(self, wave: "_Wave", slot: int) -> pa.RecordBatch:
        search, place = np.nonzero(self.scores > NONE)
        ids = pa.array(self.ids[search, place], mask=~self.known[search, place])
        anchor_ids = pa.array(wave.ids[search], mask=~wave.known[search])
        columns = [wave.numbers[search], anchor_ids, np.full(len(search), slot, dtype=np.int32), ids, self.scores[search, place], self.own[search, place]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "anchor_id", "slot", "id", "score", "own"])


class _Wave:
    """A wave's anchors side by side, as residues."""

    def __init__(self, rows: list[dict], width: int, primes: list[int]):
        blocks = [_Block(row, width) for row in rows]
        self.labels = np.concatenate([b.labels for b in blocks])
        self.ids = np.concatenate([b.ids for b in blocks])
        self.known = np.concatenate([b.known for b in blocks])
        self.matrix = np.concatenate([b.matrix for b in blocks])
        self.numbers = np.concatenate([(b.number << 12) + np.arange(b.n) for b in blocks])
        self.left = residues(self.matrix, primes)

    def parts(self) -> Iterator[slice]:
        return (slice(k, k + ANCHORS_AT_ONCE) for k in range(0, len(self.labels), ANCHORS_AT_ONCE))


def _scores(wave: _Wave, at: slice, right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    return exact_product([x[at] for x in wave.left], right, primes)


def _blocks(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[_Block]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield _Block(batch.slice(k, 1).to_pylist()[0], width)


def _positives(anchors: Broadcast, width: int, primes: list[int], bound: int, most: int):
    """The best rows of an anchor's own label. The anchor itself is marked, so one more is kept."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wave = _Wave(anchors.value, width, primes)
        best = _Best(len(wave.labels), most + 1)
        for block in _blocks(batches, width):
            right = residues(block.matrix, primes)
            for at in wave.parts():
                scores = _scores(wave, at, right, primes)
                found, places = best_first(scores, wave.labels[at, None] == block.labels, most + 1, bound)
                own = (found > NONE) & (block.known[places] == wave.known[at, None]) & (block.ids[places] == wave.ids[at, None])
                for k, j in zip(*np.nonzero(own)):  # the same id is not enough: the rows must be alike
                    own[k, j] = np.array_equal(block.matrix[places[k, j]], wave.matrix[at][k])
                best.merge(at, found, block.ids[places], block.known[places], own)
        yield best.rows(wave, 0)

    return run


def _negatives(anchors: Broadcast, positives: Broadcast, width: int, primes: list[int], bound: int, most: int, slots: int):
    """The best rows of other labels within each positive's window, given as (anchor, slot, least, largest)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wave = _Wave(anchors.value, width, primes)
        place = {number: k for k, number in enumerate(wave.numbers.tolist())}
        least = np.full((len(place), slots), 1, dtype=np.int64)
        largest = np.zeros((len(place), slots), dtype=np.int64)  # an empty window
        for anchor, slot, low, high in positives.value:
            least[place[anchor], slot], largest[place[anchor], slot] = low, high
        best = [_Best(len(place), most) for _ in range(slots)]
        for block in _blocks(batches, width):
            right = residues(block.matrix, primes)
            for at in wave.parts():
                scores = _scores(wave, at, right, primes)
                ordered, places = best_first(scores, wave.labels[at, None] != block.labels, block.n, bound)
                falling = -ordered
                for slot in range(slots):
                    low, high = least[at, slot], largest[at, slot]
                    if not (low <= high).any():
                        continue
                    first = np.array([np.searchsorted(row, -limit) for row, limit in zip(falling, high)])
                    index = first[:, None] + np.arange(most)
                    inside = index < block.n
                    index = np.minimum(index, block.n - 1)
                    found = np.take_along_axis(ordered, index, axis=1)
                    found = np.where(inside & (found >= low[:, None]) & (low <= high)[:, None], found, NONE)
                    at_rows = np.take_along_axis(places, index, axis=1)
                    best[slot].merge(at, found, block.ids[at_rows], block.known[at_rows])
        for slot in range(slots):
            yield best[slot].rows(wave, slot)

    return run


def usable(rows: DataFrame, vector_col: str) -> Column:
    """A vector that is there, with finite numbers throughout."""
    kept = F.forall(F.col(vector_col).cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector_col).isNotNull() & F.coalesce(kept, F.lit(False))


def window_of(score: int, low: int, high: int) -> tuple[int, int]:
    """The whole scores between ``low`` and ``high`` percent of this one."""
    return -(-low * score // 100), high * score // 100


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """For each anchor and each of its first ``positives`` rows of the same label, the first
    ``negatives`` rows of other labels that score between ``low`` and ``high`` percent of it."""
    spark = rows.sparkSession
    ship_package(spark)
    clean = rows.filter(F.col(label_col).isNotNull() & usable(rows, vector_col))
    chosen = [F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector")]
    tasks = block_count(rows, BYTES_A_TASK)
    blocks = stored(clean.select(*chosen).repartition(tasks).mapInArrow(_packer(scale, ROWS_A_BLOCK), BLOCK), "row-blocks")
    some = clean.filter(F.coalesce(is_anchor, F.lit(False))).select(*chosen)
    anchors = stored(some.repartition(-(-tasks // 64)).mapInArrow(_packer(scale, ANCHORS_A_BLOCK), BLOCK), "anchor-blocks")
    size = blocks.agg(F.coalesce(F.max("width"), F.lit(0)).alias("width"), F.coalesce(F.max("top"), F.lit(0)).alias("top")).first()
    bound = size["width"] * size["top"] ** 2
    if bound >= LARGEST_SCORE:
        raise OverflowError(f"{size['width']} components of up to {size['top']} may score beyond 62 bits")
    search = (size["width"], primes_for(bound, size["width"]), bound)
    numbers = sorted(r["block"] for r in anchors.select("block").collect())  # a number for up to ANCHORS_A_BLOCK anchors
    first, second = scratch_path(spark, "positives"), scratch_path(spark, "negatives")
    spark.createDataFrame([], POSITIVES).write.parquet(f"{first}/wave=none")
    spark.createDataFrame([], FOUND).write.parquet(f"{second}/wave=none")
    for start in range(0, len(numbers), BLOCKS_A_WAVE):
        wave = anchors.filter(F.col("block").isin(numbers[start : start + BLOCKS_A_WAVE])).collect()
        shared = spark.sparkContext.broadcast([row.asDict() for row in wave])
        near = blocks.mapInArrow(_positives(shared, *search, positives), FOUND)
        first_of(near, positives).write.parquet(f"{first}/wave={start}")
        found = spark.read.schema(POSITIVES).parquet(f"{first}/wave={start}").select("anchor", "slot", "positive_score").collect()
        windows = spark.sparkContext.broadcast([(r["anchor"], r["slot"], *window_of(r["positive_score"], low, high)) for r in found])
        blocks.mapInArrow(_negatives(shared, windows, *search, negatives, positives), FOUND).write.parquet(f"{second}/wave={start}")
        shared.unpersist()
        windows.unpersist()
    best = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    mined = spark.read.schema(FOUND).parquet(f"{second}/wave=*").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
    mined = mined.select("anchor", "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = spark.read.schema(POSITIVES).parquet(f"{first}/wave=*")
    return pairs.join(mined, ["anchor", "slot"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def first_of(near: DataFrame, positives: int) -> DataFrame:
    """The first ``positives`` of what the tasks found for an anchor, itself left out."""
    copies = Window.partitionBy("anchor", "own").orderBy("score")
    in_order = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    others = near.withColumn("copy", F.row_number().over(copies)).filter("not (own and copy = 1)")  # one such row is the anchor
    ranked = others.withColumn("slot", F.row_number().over(in_order) - 1).filter(F.col("slot") < positives)
    return ranked.select("anchor", "anchor_id", "slot", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
