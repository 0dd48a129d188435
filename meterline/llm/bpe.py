"""Byte-level BPE: encoding by merge ranks and decoding.

The merges of one pre-token are driven by a queue over merge ranks: each rank
has a bucket of positions in a linked list of parts, and a bitmap of three
levels tells which buckets hold something, so that the next rank is found by
three find-first-set steps however long the pre-token is. Entries are not
removed when a merge changes a neighbour; they are recognised as stale when
they are popped. A pre-token of n bytes takes O(n log n) steps.

Defined results: a null or empty text has no ids and decodes to no bytes; rows
with equal or null ids are encoded one by one; other columns are left behind,
so that none can clash.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from meterline.llm.common import kept_by_worker, texts

#: So many words are remembered by each Python worker; words met after that are encoded each time.
REMEMBERED = 300_000
#: Pre-tokens of up to so many bytes are merged side by side, longer ones each by itself.
SHORT = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class RankQueue:
    """Positions under ranks below ``size``; ``pop`` gives the lowest rank, and of that the lowest position."""

    def __init__(self, size: int):
        self.buckets: list[list[int] | None] = [None] * size
        self.levels: list[list[int]] = []
        while True:
            size = -(-size // 64)
            self.levels.append([0] * size)
            if size == 1:
                break

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets[rank]
        if bucket:
            heappush(bucket, position)
            return
        if bucket is None:
            self.buckets[rank] = [position]
        else:
            bucket.append(position)
        self._filled(rank)

    def lowest(self) -> int | None:
        """The lowest rank whose bucket holds something."""
        rank = 0
        for level in reversed(self.levels):
            word = level[rank]
            if not word:
                return None
            rank = rank << 6 | ((word & -word).bit_length() - 1)
        return rank

    def pop(self) -> tuple[int, int] | None:
        rank = self.lowest()
        if rank is None:
            return None
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            self._emptied(rank)
        return rank, position

    def pop_bucket(self) -> tuple[int, list] | None:
        """All that is held under the lowest rank."""
        rank = self.lowest()
        if rank is None:
            return None
        bucket, self.buckets[rank] = self.buckets[rank], None
        self._emptied(rank)
        return rank, bucket

    def put(self, rank: int, positions: np.ndarray) -> None:
        """Many positions at once, for ``pop_bucket``; between two uses a queue is empty."""
        bucket = self.buckets[rank]
        if bucket:
            bucket.append(positions)
            return
        self.buckets[rank] = [positions]
        self._filled(rank)

    def _filled(self, rank: int) -> None:
        for level in self.levels:
            word, bit = rank >> 6, 1 << (rank & 63)
            before = level[word]
            level[word] = before | bit
            if before:
                return
            rank = word

    def _emptied(self, rank: int) -> None:
        for level in self.levels:
            word = rank >> 6
            level[word] &= ~(1 << (rank & 63))
            if level[word]:
                return
            rank = word


class Merger:
    """Encodes pre-tokens, given as bytes: one long one by itself, many short ones side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.of_byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ranks = np.array([*map(pairs.__getitem__, self.pair_keys.tolist()), -1], dtype=np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank that each pair of tokens merges to, -1 if none."""
        if not len(self.pair_keys):
            return np.full(len(left), -1)
        key = left << 32 | right
        at = np.searchsorted(self.pair_keys, key)
        found = self.pair_keys[np.minimum(at, len(self.pair_keys) - 1)] == key
        return np.where(found, self.pair_ranks[at], -1)

    def encode_all(self, pieces: list[bytes]) -> list[bytes]:
        """The packed ids of each of many short pieces.

        One queue serves all of them. All of a bucket is merged in one step,
        but of each piece only the leftmost entry; the others go back, because
        a merge may bring forth a lower rank beside it.
        """
        token = self.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        n = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        ends = np.cumsum(n)
        size = len(token)
        piece = np.repeat(np.arange(len(pieces)), n)
        after, before = np.arange(1, size + 1), np.arange(-1, size - 1)
        after[ends - 1] = -1
        before[ends - n] = -1
        alive = np.ones(size, dtype=bool)
        pair = np.append(np.where(after[:-1] >= 0, self.rank_of(token[:-1], token[1:]), -1), -1)
        queue = self.queue
        self._put(np.flatnonzero(pair >= 0), pair)
        while (got := queue.pop_bucket()) is not None:
            rank, held = got
            at = held[0] if len(held) == 1 else np.unique(np.concatenate(held))
            at = at[pair[at] == rank]  # the others are stale
            if not len(at):
                continue
            if len(at) > 1:
                of = piece[at]
                first = np.ones(len(at), dtype=bool)
                first[1:] = of[1:] != of[:-1]
                if not first.all():
                    queue.put(rank, at[~first])
                    at = at[first]
            gone = after[at]
            end = after[gone]
            token[at], after[at], alive[gone], pair[gone] = rank, end, False, -1
            inner = end >= 0
            before[end[inner]] = at[inner]
            pair[at] = -1
            left = before[at]
            changed = np.concatenate([at[inner], left[left >= 0]])
            if len(changed):
                pair[changed] = self.rank_of(token[changed], token[after[changed]])
                self._put(changed[pair[changed] >= 0], pair)
        packed = token[alive].astype("<u4").tobytes()
        cut = np.cumsum(np.bincount(piece[alive], minlength=len(pieces))) * 4
        return [packed[a:b] for a, b in zip([0, *cut[:-1].tolist()], cut.tolist())]

    def _put(self, positions: np.ndarray, pair: np.ndarray) -> None:
        """Under the rank of the pair that begins at each position, in ascending order."""
        if len(positions) == 1:
            self.queue.put(int(pair[positions[0]]), positions)
            return
        ranks = pair[positions]
        order = np.lexsort((positions, ranks))
        positions, ranks = positions[order], ranks[order]
        cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b > a:
                self.queue.put(int(ranks[a]), positions[a:b])

    def encode(self, piece: bytes) -> list[int]:
        ranks, push, pop = self.ranks, self.queue.push, self.queue.pop
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        after = list(range(1, n + 1))  # where the part that starts here ends
        before = list(range(-1, n - 1))
        pair: list[int | None] = [None] * n  # rank of this part and the next, None if they don't merge
        for i in range(n - 1):
            rank = ranks.get(piece[i : i + 2])
            if rank is not None:
                pair[i] = rank
                push(rank, i)
        while (got := pop()) is not None:
            rank, i = got
            if pair[i] != rank:
                continue  # stale
            gone = after[i]
            end = after[gone]
            after[i] = end
            pair[gone] = None
            if end < n:
                before[end] = i
                joined = pair[i] = ranks.get(piece[i : after[end]])
                if joined is not None:
                    push(joined, i)
            else:
                pair[i] = None
            if i:
                left = before[i]
                joined = pair[left] = ranks.get(piece[left:end])
                if joined is not None:
                    push(joined, left)
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : after[i]]])
            i = after[i]
        return ids


class TextEncoder:
    """Whole texts to ids. ``encode_all`` gives the packed ids of strings.

    A text is cut at single spaces and single line ends that stand between
    other characters: no match of the pattern crosses such a place, the space
    going to the word behind it. Each distinct word of many texts is encoded
    once and kept. Texts with other runs of white space are encoded whole.
    """

    def __init__(self, encode_all):
        self.encode_all = encode_all
        self.kept: dict[str, bytes] = {}

    @staticmethod
    def words(text: str) -> list[str]:
        """The parts that can be encoded by themselves."""
        if not text:
            return []
        words: list[str] = []
        for line in text.split("\n"):
            cut = line.split(" ")
            if not all(cut):  # an empty line, or a run of spaces
                return [text]
            cut[1:] = map(" ".__add__, cut[1:])
            words += cut
            words.append("\n")
        words.pop()
        return words

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.words(text) for text in texts]
        missing = set(chain.from_iterable(cut)).difference(self.kept)
        odd = {w for w in missing if w != "\n" and any(map(str.isspace, w[w[0] == " " :]))}
        if odd:
            cut = [[text] if odd.intersection(words) else words for text, words in zip(texts, cut)]
            missing = set(chain.from_iterable(cut)).difference(self.kept)
        wanted = list(missing)
        found = dict(zip(wanted, self.encode_all(wanted)))
        self.kept.update(found)
        ids = [b"".join(map(self.kept.__getitem__, words)) for words in cut]
        while len(self.kept) > REMEMBERED:
            self.kept.popitem()  # the latest, and so rarest, go first
        return ids


def rank_encoder(ranks: dict[bytes, int], pattern: str) -> TextEncoder:
    merger, cut = Merger(ranks), regex.compile(pattern)

    def encode_all(words: list[str]) -> list[bytes]:
        pieces = [[m.encode() for m in cut.findall(w)] for w in words]
        known: dict[bytes, bytes] = {}
        short = []
        for piece in set(chain.from_iterable(pieces)):
            rank = ranks.get(piece)
            if rank is not None:
                known[piece] = rank.to_bytes(4, "little")
            elif len(piece) <= SHORT:
                short.append(piece)
            else:
                known[piece] = np.array(merger.encode(piece), dtype="<u4").tobytes()
        if short:
            known.update(zip(short, merger.encode_all(short)))
        return [b"".join(map(known.__getitem__, x)) for x in pieces]

    return TextEncoder(encode_all)


def id_lists(blobs: list[bytes]) -> pa.Array:
    """A list of ids for each document, from its ids' bytes."""
    offsets = np.zeros(len(blobs) + 1, dtype=np.int32)
    np.cumsum([len(b) // 4 for b in blobs], out=offsets[1:])
    flat = np.frombuffer(b"".join(blobs), dtype="<u4").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def in_portions(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose ``column`` takes about ``most`` bytes; a longer value is a part of its own."""
    offsets = np.cumsum([0, *(x.as_buffer().size if x.is_valid else 0 for x in batch.column(column))])
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1)
        yield batch.slice(start, end - start)
        start = end


class TokenTable:
    """The bytes that each id stands for."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.tokens = pa.array(tokens, pa.large_binary())

    def decode(self, ids: pa.Array) -> pa.Array:
        """For each list of ids their bytes, in one pass over all of them."""
        flat = self.tokens.take(ids.flatten())
        begins = np.frombuffer(flat.buffers()[1], dtype=np.int64)[flat.offset : flat.offset + len(flat) + 1]
        ends = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))])
        data = memoryview(flat.buffers()[2] or b"")
        cuts = begins[ends] if len(flat) else ends
        return pa.array([bytes(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_decoded: bool = False
) -> DataFrame:
    """``doc_id`` and ``ids``, the encoding of each whole text; ``decoded`` too, made from the ids, if asked for.

    The ranks travel to the executors in a broadcast; their number is fixed.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_by_worker(("ranks", ranks_path, pattern), lambda: rank_encoder(shared.value, pattern))
        table = TokenTable(shared.value) if with_decoded else None
        for batch in batches:
            for part in in_portions(batch, "text"):
                columns = {"doc_id": part.column("doc_id"), "ids": id_lists(encoder.many(part.column("text").to_pylist()))}
                if table:
                    columns["decoded"] = table.decode(columns["ids"])
                yield pa.RecordBatch.from_pydict(columns)

    source = texts(docs, id_col, text_col)
    layout = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids array<int>"
    return source.mapInArrow(run, layout + ", decoded binary" * with_decoded)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The rows of ``encode`` with ``decoded``, the bytes that the ids stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = TokenTable(shared.value)
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                columns = {"doc_id": part.column("doc_id"), "ids": part.column("ids"), "decoded": table.decode(part.column("ids"))}
                yield pa.RecordBatch.from_pydict(columns)

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")
