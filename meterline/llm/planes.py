"""Token ids as a binary table of compressed planes, with an index of its chunks.

Documents are put into ascending order of their ids by ranges (shards); each
shard writes its token ids in chunks of a fixed number. A chunk is transposed
into planes, one for each bit (or byte) of an id, and every plane is
compressed by itself with zstandard. Special strings in a text are the ids that
the library takes them for by default. Beside its planes a chunk holds what it
has of which document. The index table tells for each chunk how many ids come
before it. Both tables are parquet, so any store that Spark writes to serves.

Defined results: a null or empty text is the end id alone; documents without
an id come first; rows with equal ids stand in the order of their texts, each
with its own ids; an empty table gives empty tables; columns other than the
two named ones are left behind. A document may be longer than a chunk.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterline.llm.bpe import in_portions
from meterline.llm.common import block_count, texts
from meterline.llm.words import ColumnEncoder

CHUNK_IDS = 1 << 16
#: So many bytes of texts are encoded at a time: the more, the fewer words are looked up again.
PORTION_BYTES = 6 << 20
PIECES = "array<struct<doc_id: {kind}, begin: bigint, n_tokens: bigint, offset: bigint, length: int>>"
#: Shards whose sizes are summed together before the sums of such groups are.
SHARDS_A_GROUP = 1024


def to_planes(ids: np.ndarray, unit: str) -> list[bytes]:
    """One compressed plane for each bit or byte that the largest id has, the lowest first."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    bits = max(1, int(ids.max(initial=0)).bit_length())
    if unit == "byte":
        octets = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
        return [squeeze(np.ascontiguousarray(octets[:, k]).tobytes()) for k in range(-(-bits // 8))]
    if unit == "bit":
        return [squeeze(np.packbits(((ids >> np.uint32(k)) & np.uint32(1)).astype(bool)).tobytes()) for k in range(bits)]
    raise ValueError(f"planes are of a 'bit' or a 'byte', not {unit!r}")


def from_planes(planes: list[bytes], n: int, unit: str) -> np.ndarray:
    ids = np.zeros(n, dtype="<u4")
    expand = zstandard.ZstdDecompressor().decompress
    for k, plane in enumerate(planes):
        raw = np.frombuffer(expand(plane), dtype=np.uint8)
        if unit == "bit":
            ids |= np.unpackbits(raw, count=n).astype("<u4") << np.uint32(k)
        else:
            ids |= raw.astype("<u4") << np.uint32(8 * k)
    return ids


class _Chunks:
    """Cuts a shard's documents into chunks."""

    def __init__(self, shard: int, unit: str, size: int):
        self.shard, self.unit, self.size = shard, unit, size
        self.count = self.written = 0
        self.held: list[np.ndarray] = []
        self.pieces: list[dict] = []
        self.filled = 0

    def add(self, doc_id, ids: np.ndarray) -> Iterator[dict]:
        begin, offset = self.written + self.filled, 0
        while offset < len(ids):
            part = ids[offset : offset + self.size - self.filled]
            self.held.append(part)
            self.pieces.append(dict(doc_id=doc_id, begin=begin, n_tokens=len(ids), offset=offset, length=len(part)))
            self.filled += len(part)
            offset += len(part)
            if self.filled == self.size:
                yield self.close()

    def close(self) -> dict:
        ids = np.concatenate(self.held)
        row = dict(shard=self.shard, chunk=self.count, n_ids=len(ids), unit=self.unit, planes=to_planes(ids, self.unit), pieces=self.pieces)
        self.count, self.written, self.held, self.pieces, self.filled = self.count + 1, self.written + len(ids), [], [], 0
        return row


def library_encoder(vocabulary: str) -> ColumnEncoder:
    """Encodes with the tokenizers library from the text of its json file, special strings as it does by default."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    batch = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
    special = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
    tokens = tokenizer.get_vocab()
    n_bytes = np.zeros(max(tokens.values(), default=0) + 1, dtype=np.int64)  # a character of a token stands for a byte
    n_bytes[list(tokens.values())] = [len(t) for t in tokens]
    return ColumnEncoder(lambda words: [x.ids for x in batch(words, add_special_tokens=False)], special, n_bytes)


_encoders: dict[str, ColumnEncoder] = {}


def write_ids(
    docs: DataFrame,
    vocabulary_path: str,
    path: str,
    end_id: int = 0,
    unit: str = "byte",
    chunk_ids: int = CHUNK_IDS,
    bytes_a_shard: int = 32 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write ``path/chunks`` and ``path/index`` with the ids of all documents, each followed by ``end_id``."""
    spark = docs.sparkSession
    with open(vocabulary_path, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())
    source = texts(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    ordered = source.repartitionByRange(block_count(docs, bytes_a_shard), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    layout = f"shard int, chunk int, n_ids int, unit string, planes array<binary>, pieces {PIECES.format(kind=kind)}"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary_path not in _encoders:  # one per Python worker, so that the words it knows serve all tasks
            _encoders[vocabulary_path] = library_encoder(shared.value)
        encoder = _encoders[vocabulary_path]
        chunks, schema = _Chunks(TaskContext.get().partitionId(), unit, chunk_ids), None
        end = np.array([end_id], dtype="<u4")

        def batch_of(row: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            piece = pa.struct([("doc_id", batch.schema.field("doc_id").type), ("begin", pa.int64()), ("n_tokens", pa.int64()), ("offset", pa.int64()), ("length", pa.int32())])
            schema = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("n_ids", pa.int32()), ("unit", pa.string()), ("planes", pa.list_(pa.binary())), ("pieces", pa.list_(piece))])
            for part in in_portions(batch, "text", PORTION_BYTES):
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.many(part.column("text"))):
                    yield from map(batch_of, chunks.add(doc_id, np.concatenate([ids, end])))
        if chunks.filled:
            yield batch_of(chunks.close())

    ordered.mapInArrow(run, layout).write.option("compression", "none").parquet(f"{path}/chunks")
    sizes = spark.read.parquet(f"{path}/chunks").select("shard", "chunk", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("ids")).withColumn("shards", F.floor(F.col("shard") / SHARDS_A_GROUP))
    groups = shards.groupBy("shards").agg(F.sum("ids").alias("ids"))
    start = groups.select("shards", F.coalesce(F.sum("ids").over(Window.orderBy("shards").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    within = Window.partitionBy("shards").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    first = shards.join(start, "shards").select("shard", (F.col("start") + F.coalesce(F.sum("ids").over(within), F.lit(0))).alias("shard_first"))
    order = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    index = sizes.join(first, "shard").select("shard", "chunk", "n_ids", "shard_first", (F.col("shard_first") + F.coalesce(F.sum("n_ids").over(order), F.lit(0))).alias("first"))
    index.write.parquet(f"{path}/index")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens``, ``ids`` as little-endian 32-bit integers.

    A document that lies within one chunk is read from it; the pieces of the
    others, at most two documents a chunk, are brought together by a shuffle.
    """
    chunks = spark.read.parquet(f"{path}/chunks")
    index = spark.read.parquet(f"{path}/index").select("shard", "shard_first").distinct()
    kind = chunks.schema["pieces"].dataType.elementType["doc_id"].dataType.simpleString()
    layout = f"shard int, doc_id {kind}, begin bigint, n_tokens bigint, offset bigint, ids binary"

    def reader(whole: bool):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    row = batch.slice(k, 1)
                    pieces = row.column("pieces").flatten()
                    begin, n, offset, length = (np.asarray(pieces.field(x)) for x in ("begin", "n_tokens", "offset", "length"))
                    wanted = np.flatnonzero((length == n) == whole)
                    if not len(wanted):
                        continue
                    ids = from_planes(row.column("planes")[0].as_py(), row.column("n_ids")[0].as_py(), row.column("unit")[0].as_py()).tobytes()
                    ends = np.cumsum(length, dtype=np.int64) * 4
                    blobs = [ids[ends[i] - 4 * length[i] : ends[i]] for i in wanted]
                    shard = pa.array(np.full(len(wanted), row.column("shard")[0].as_py(), dtype=np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [shard, pieces.field("doc_id").take(pa.array(wanted)), *(pa.array(x[wanted]) for x in (begin, n, offset)), pa.array(blobs, pa.binary())],
                        ["shard", "doc_id", "begin", "n_tokens", "offset", "ids"],
                    )

        return run

    near = chunks.mapInArrow(reader(True), layout).drop("offset")
    pieces = chunks.mapInArrow(reader(False), layout)
    joined = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    far = pieces.groupBy("shard", "doc_id", "begin", "n_tokens").agg(joined.alias("parts"))
    glued = F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), ""))
    far = far.select("shard", "doc_id", "begin", "n_tokens", glued.alias("ids"))
    start = (F.col("shard_first") + F.col("begin")).alias("start")
    return near.unionByName(far).join(index, "shard").select("doc_id", start, "n_tokens", "ids")
