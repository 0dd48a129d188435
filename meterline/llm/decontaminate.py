"""Benchmark decontamination by SimHash windows of an item's size.

A window can only be alike an item if they share a shingle, so windows are
laid where a shared shingle falls on its place in the item. Windows and items
get SimHash fingerprints; these are cut into one block more than the radius,
so that fingerprints within the radius agree in a block, and every such pair
is found by looking blocks up. Candidates within the radius are verified by
exact similarity: shared over all shingles, each weighted by how often it
occurs. Everything is a DataFrame operation.

Words are runs of letters and digits in lower case; a shingle is five of them,
or all words of a text that has fewer. For items of fewer words, runs of as
many words of the documents are looked up too.

Defined results: documents and items without words match nothing; rows with
equal id and text count as one document, documents without an id are matched
under a null id; several items with one id are one row for each document with
the best window of all; an empty table on either side gives no rows; further
columns are left behind by ``contaminations`` and kept by ``decontaminate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import texts
from meterline.operators.joins import fits_broadcast

SHINGLE = 5
LEAST_SIMILARITY = 0.8
#: Fingerprints of 64 bits of texts 0.8 alike differ in 10 bits on average, with a deviation of 3.
RADIUS = 20
#: Benchmarks of more shingles than this are joined by a shuffle.
BROADCAST_SHINGLES = 500_000


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(parts: Column) -> Column:
    """A hash for each shingle, in order; none without words."""
    n = F.size(parts)
    every = F.transform(F.sequence(F.lit(1), n - (SHINGLE - 1)), lambda k: F.xxhash64(F.slice(parts, k, F.lit(SHINGLE))))
    return F.when(n == 0, F.array().cast("array<bigint>")).when(n <= SHINGLE, F.array(F.xxhash64(parts))).otherwise(every)


def placed_shingles(parts: Column, sizes: list[int]) -> Column:
    """Each run of as many words as one of ``sizes`` says: its first word's place and its hash, as ``shingles`` has it."""

    def of(size: int) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(parts) - size), lambda k: F.struct(k.alias("at"), F.xxhash64(F.slice(parts, k + 1, F.lit(size))).alias("shingle")))
        return F.when(F.size(parts) >= size, runs).otherwise(F.array().cast("array<struct<at: int, shingle: bigint>>"))

    return F.concat(*map(of, sizes))


def simhash(hashes: Column) -> Column:
    """Each bit is that of most shingles, a shingle counting as often as it occurs."""

    def bit(k: Column) -> Column:
        balance = F.aggregate(hashes, F.lit(0), lambda total, h: total + F.when(F.getbit(h, k) == 1, 1).otherwise(-1))
        return F.when(balance > 0, 1).otherwise(0)

    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), bit)
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda number, b: F.shiftleft(number, 1).bitwiseOR(b.cast("bigint")))


def blocks(print_: Column, radius: int = RADIUS) -> Column:
    """The ``radius + 1`` blocks of a fingerprint, each with its number."""
    cuts = [64 * k // (radius + 1) for k in range(radius + 2)]
    return F.array(
        *(
            F.struct(F.lit(k).alias("number"), F.shiftrightunsigned(print_, a).bitwiseAND((1 << (b - a)) - 1).alias("value"))
            for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))
        )
    )


def similarity(one: Column, other: Column) -> Column:
    """Shared over all shingles of two arrays, by how often each occurs."""
    often = lambda side, x: F.size(F.filter(side, lambda y: y == x))
    every = F.array_distinct(F.concat(one, other))
    shared = F.aggregate(every, F.lit(0), lambda total, x: total + F.least(often(one, x), often(other, x)))
    return shared / (F.size(one) + F.size(other) - shared)


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least: float = LEAST_SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """For each document and item whose text it holds: the most similar window, its first word, length, distance and similarity."""
    items = benchmark.select(benchmark[item_col].alias("item_id"), words(F.coalesce(benchmark[item_text_col], F.lit(""))).alias("item_words"))
    items = items.select("item_id", F.size("item_words").alias("n_words"), shingles(F.col("item_words")).alias("item_shingles")).where("n_words > 0").distinct()
    item_places = items.select("item_id", "n_words", F.size("item_shingles").alias("n_shingles"), F.posexplode("item_shingles").alias("place", "shingle"))
    if fits_broadcast(item_places, BROADCAST_SHINGLES):
        item_places = F.broadcast(item_places)
    source = texts(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text")).withColumn("doc_words", words(F.col("text")))
    sizes = sorted(r.size for r in items.select(F.least("n_words", F.lit(SHINGLE)).alias("size")).distinct().collect())  # five at most
    placed = source.select("doc_id", "text_hash", F.size("doc_words").alias("doc_n"), F.inline(placed_shingles(F.col("doc_words"), sizes or [SHINGLE])))
    last = F.greatest(F.lit(0), F.col("doc_n") - F.col("n_words"))
    begin = F.least(last, F.greatest(F.lit(0), F.col("at") - F.col("place")))
    # a window this similar shares at least that part of the item's shingles
    hits = placed.join(item_places, "shingle").groupBy("doc_id", "text_hash", "item_id", "n_words", "n_shingles")
    # all windows equal to an item of one shingle are alike, and the first of them is the best
    several = F.collect_set(F.when(F.col("n_shingles") > 1, begin))
    begins = F.when(F.col("n_shingles") > 1, several).otherwise(F.array(F.min(begin))).alias("begins")
    hits = hits.agg(F.count("*").alias("hits"), begins).where(F.col("hits") >= least * F.col("n_shingles"))
    wanted = hits.groupBy(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"))
    wanted = wanted.agg(F.collect_set(F.struct("item_id", "n_words", "begins")).alias("wanted"))
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    found = source.drop("doc_words").join(wanted, same).withColumn("doc_words", words(F.col("text"))).withColumn("w", F.explode("wanted"))
    found = found.select("doc_id", "text_hash", "doc_words", "w.item_id", "w.n_words", F.explode("w.begins").alias("begin"))
    window = F.slice(F.col("doc_words"), F.col("begin") + 1, F.col("n_words"))
    windows = found.select("doc_id", "text_hash", "item_id", "n_words", "begin", shingles(window).alias("shingles"))
    windows = windows.withColumn("print", simhash(F.col("shingles")))
    block = F.explode(blocks(F.col("print"), radius)).alias("block")
    index = items.withColumn("item_print", simhash(F.col("item_shingles")))
    index = index.select("item_id", "n_words", "item_shingles", "item_print", F.explode(blocks(F.col("item_print"), radius)).alias("block"))
    pairs = windows.select("*", block).join(index, ["item_id", "n_words", "block"]).drop("block")
    pairs = pairs.withColumn("distance", F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))).where(F.col("distance") <= radius)
    pairs = pairs.dropDuplicates(["doc_id", "text_hash", "item_id", "n_words", "begin", "item_print"])
    pairs = pairs.withColumn("similarity", similarity(F.col("shingles"), F.col("item_shingles"))).where(F.col("similarity") >= least)
    best = F.max_by(F.struct("begin", "n_words", "distance"), F.struct("similarity", -F.col("begin"))).alias("b")
    held = pairs.groupBy("doc_id", "text_hash", "item_id").agg(best, F.max("similarity").alias("similarity"))
    return held.select("doc_id", "text_hash", "item_id", "b.begin", "b.n_words", "b.distance", "similarity")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that hold no item, with all their columns."""
    held = contaminations(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias("_held_id"), F.col("text_hash").alias("_held_hash"))
    same = docs[id_col].eqNullSafe(F.col("_held_id")) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == F.col("_held_hash"))
    return docs.join(held, same, "left_anti")
