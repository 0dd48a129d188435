"""Bigram language scores by deleted interpolation.

The probability of a token after another mixes the maximum-likelihood
estimates of the pair and of the token with a uniform one. The weights depend
on how often the context was seen (a bucket for each power of two) and are
learned by expectation maximisation on a part of the training documents, from
counts that leave this part out.

Counts cover the whole corpus and nothing of them is broadcast or collected.
Documents are dealt to blocks of about equal size. A block sends the distinct
keys (64-bit hashes of words and of pairs) it holds, with its own counts, to
the task that owns their range; that task sums them and answers each block in
the order of its keys. Blocks then write what scoring needs:
for each token of each document its count and that of the pair it ends.

Words are cut at ASCII white space, A-Z in lower case; a document is its words
and one end, and the end also is the context of the first word.

Defined results: a null or empty text is its end alone; rows without an id or
with equal ids are scored one by one (they are dealt by id and text) and count
in training as often as they stand there; without training documents only the
uniform estimate is left; without a part to learn weights on they are equal;
an empty table gives an empty table; further columns are left behind.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import block_count, stored, texts
from meterline.llm.packing import numbers as _numbers
from meterline.llm.packing import packed as _packed
from meterline.llm.packing import read as _read
from meterline.llm.packing import unpacked as _unpacked

#: Compressed input that makes a block.
BLOCK_BYTES = 8 << 20
BUCKETS = 48
#: For learning the weights, logarithms of estimates are counted in steps of this part of an octave.
STEPS = 8
REMEMBERED = 600_000
END = np.uint64(0x5D1F3C9A7B2E4680)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
WORD, PAIR = 0, 1
#: Pairs are told apart by 52 bits (words by 64), which makes their keys cheaper to send.
PAIR_BITS = np.uint64(0xFFFFFFFFFFFFF000)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = number = xxhash.xxh3_64_intdigest(word)
        return number


def _tokens(batch: Iterable[str], hashes: _WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """The hashed tokens of all texts, each closed by its end, and how many each has."""
    sizes, parts = [], []
    end = np.array([END])
    for text in batch:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        parts += [np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words)), end]
        sizes.append(len(words) + 1)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.array(sizes, dtype=np.int64)


def _pairs(tokens: np.ndarray) -> np.ndarray:
    """A key for each token with the one before it; all texts end alike, so the end before a text is its context."""
    before = np.concatenate([[END], tokens[:-1]])
    with np.errstate(over="ignore"):
        x = (before * MULTIPLIER) ^ (tokens + (before >> np.uint64(29)))
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(30))) & PAIR_BITS


@dataclass
class _Block:
    """A block's documents as tokens, and its distinct keys with their counts."""

    tokens: np.ndarray
    sizes: np.ndarray
    learned: np.ndarray  # for each document: 0 not learned from, 1 learned from, 2 also used for the weights

    @classmethod
    def of(cls, table: pa.Table) -> _Block:
        tokens, sizes = _tokens((x.as_py() for x in table.column("text")), _WordHashes())
        return cls(tokens, sizes, table.column("part").to_numpy())

    def counted(self, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys, for each token the place of its key, the counts in training, those of the weights' part."""
        keys, place = np.unique(self.tokens if kind == WORD else _pairs(self.tokens), return_inverse=True)
        part = np.repeat(self.learned, self.sizes)
        train = np.bincount(place[part > 0], minlength=len(keys))
        return keys, place, train, np.bincount(place[part == 2], minlength=len(keys))


ASKED = "kind int, range int, block int, keys binary, train binary, held binary"
ANSWERED = "block int, kind int, range int, train binary, held binary, new_words bigint"


def _cuts(keys: np.ndarray, ranges: int) -> list[int]:
    """Where ascending keys fall into the ranges: the borders, with both ends."""
    borders = np.array([(k << 64) // ranges for k in range(1, ranges)], dtype=np.uint64)
    return [0, *np.searchsorted(keys, borders).tolist(), len(keys)]


def _ask(ranges: int):
    def ask(table: pa.Table) -> pa.Table:
        block, rows = _Block.of(table), []
        number = table.column("block")[0].as_py()
        for kind in (WORD, PAIR):
            keys, _, train, held = block.counted(kind)
            cuts = _cuts(keys, ranges)
            for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                if b > a:
                    rows.append((kind, k, number, _packed(keys[a:b]), _numbers(train[a:b]), _numbers(held[a:b])))
        names = ("kind", "range", "block", "keys", "train", "held")
        types = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.table({n: pa.array(x, t) for n, x, t in zip(names, zip(*rows), types)})

    return ask


def _answer(table: pa.Table) -> pa.Table:
    """Sum a range's keys over all blocks and tell each block the sums, in the order in which it asked."""
    asked = [(r["block"], _unpacked(r["keys"]), _read(r["train"]), _read(r["held"])) for r in table.to_pylist()]
    kind, number_of_range = table.column("kind")[0].as_py(), table.column("range")[0].as_py()
    every, place = np.unique(np.concatenate([k for _, k, _, _ in asked]), return_inverse=True)
    train = np.bincount(place, np.concatenate([t for _, _, t, _ in asked]), len(every)).astype(np.uint64)
    held = np.bincount(place, np.concatenate([h for _, _, _, h in asked]), len(every)).astype(np.uint64)
    words, rows, first = int((train > 0).sum()) if kind == WORD else 0, [], 0
    for number, keys, _, _ in asked:
        at = place[first : first + len(keys)]
        first += len(keys)
        rows.append((number, kind, number_of_range, _numbers(train[at]), _numbers(held[at]), words))
        words = 0
    names = ("block", "kind", "range", "train", "held", "new_words")
    types = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64())
    return pa.table({n: pa.array(x, t) for n, x, t in zip(names, zip(*rows), types)})


def _joined(docs: pa.Table, answers: pa.Table, ranges: int) -> pa.Table:
    """For each document the counts of its tokens and pairs; for those of the weights' part also what that part has of them."""
    block = _Block.of(docs)
    replies = answers.to_pylist()
    columns = {}
    for kind, name in ((WORD, "word"), (PAIR, "pair")):
        keys, place, train, held = block.counted(kind)
        cuts = _cuts(keys, ranges)
        for r in replies:
            if r["kind"] == kind:
                own = slice(cuts[r["range"]], cuts[r["range"] + 1])
                train[own], held[own] = _read(r["train"]), _read(r["held"])
        columns[name], columns[f"{name}_held"] = train[place], held[place]
    ends = np.cumsum(block.sizes)
    cut = lambda x, wanted: [_numbers(x[b - n : b]) if w else None for b, n, w in zip(ends.tolist(), block.sizes.tolist(), wanted)]
    always, weighs = [True] * len(ends), (block.learned == 2).tolist()
    new_words = [0] * docs.num_rows
    if new_words:
        new_words[0] = sum(r["new_words"] for r in replies)
    return pa.table(
        {
            "doc_id": docs.column("doc_id"),
            "part": docs.column("part"),
            "n_tokens": pa.array(block.sizes),
            "word": pa.array(cut(columns["word"], always), pa.binary()),
            "pair": pa.array(cut(columns["pair"], always), pa.binary()),
            "word_held": pa.array(cut(columns["word_held"], weighs), pa.binary()),
            "pair_held": pa.array(cut(columns["pair_held"], weighs), pa.binary()),
            "new_words": pa.array(new_words, pa.int64()),
        }
    )


def counted(docs: DataFrame, learn: Column, weigh: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document with the training counts of its tokens and pairs, written to the shared folder.

    ``learn`` and ``weigh`` are conditions on ``doc_id``: training documents, and those of them that the weights are learned on.
    """
    source = texts(docs, id_col, text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    blocks = block_count(docs, BLOCK_BYTES)
    part = F.when(learn & weigh, 2).when(learn, 1).otherwise(0)
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    # texts are moved once: both uses below find the rows of a block together
    dealt = source.select("doc_id", "text", part.alias("part"), block.alias("block")).repartition(blocks, "block")
    asked = dealt.groupBy("block").applyInArrow(_ask(blocks), ASKED)
    answered = asked.groupBy("kind", "range").applyInArrow(_answer, ANSWERED)
    layout = f"doc_id {kind}, part int, n_tokens bigint, word binary, pair binary, word_held binary, pair_held binary, new_words bigint"

    def join(docs_of_block: pa.Table, answers: pa.Table) -> pa.Table:
        return _joined(docs_of_block, answers, blocks)

    return stored(dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(join, layout), "counted")


def _estimates(word: np.ndarray, pair: np.ndarray, ends: int, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the contexts, and the estimates of the pair and of the token, for one document's counts."""
    context = np.concatenate([[ends], word[:-1]]).astype(np.float64)
    bucket = np.minimum(np.where(context > 0, np.log2(np.maximum(context, 1)).astype(np.int64) + 1, 0), BUCKETS - 1)
    return bucket, pair / np.maximum(context, 1), word / max(total, 1)


def learn_weights(counted_docs: DataFrame, vocabulary: int, rounds: int = 60) -> np.ndarray:
    """A row of weights (pair, token, uniform) for each bucket, from counts that leave out the documents learned on."""
    held = counted_docs.where("part = 2").select("word", "pair", "word_held", "pair_held", "n_tokens")
    totals = counted_docs.where("part = 1").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens")).first()
    ends, total = totals.docs, totals.tokens or 0
    none = 60 * STEPS  # an estimate of nothing

    def tally(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def step(x: np.ndarray) -> np.ndarray:
            return np.where(x > 0, np.minimum(np.round(-STEPS * np.log2(np.maximum(x, 1e-17))), none - 1), none).astype(np.int64)

        for batch in batches:
            cells = []
            for k in range(batch.num_rows):
                word, pair, word_held, pair_held = (_read(batch.column(x)[k].as_py()).astype(np.int64) for x in ("word", "pair", "word_held", "pair_held"))
                bucket, f_pair, f_word = _estimates(word - word_held, pair - pair_held, ends, total)
                cells.append((bucket * (none + 1) + step(f_pair)) * (none + 1) + step(f_word))
            if cells:
                cell, n = np.unique(np.concatenate(cells), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n)], ["cell", "n"])

    found = held.mapInArrow(tally, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    rows = found.collect()  # one for each bucket and two steps that occur: fixed numbers, whatever the corpus
    weights = np.full((BUCKETS, 3), 1 / 3)
    if not rows:
        return weights
    cell, n = np.array([r.cell for r in rows]), np.array([r.n for r in rows], dtype=np.float64)
    back = lambda s: np.where(s == none, 0.0, 2.0 ** (-s / STEPS))
    bucket = cell // (none + 1) ** 2
    estimates = np.stack([back(cell // (none + 1) % (none + 1)), back(cell % (none + 1)), np.full(len(cell), 1 / (vocabulary + 1))], axis=1)
    for _ in range(rounds):
        mixed = estimates * weights[bucket]
        share = mixed / mixed.sum(axis=1, keepdims=True) * n[:, None]
        sums = np.stack([np.bincount(bucket, share[:, k], BUCKETS) for k in range(3)], axis=1) + 0.01
        weights = sums / sums.sum(axis=1, keepdims=True)
    return weights


def score(docs: DataFrame, learn: Column, weigh: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (add-one token model) and ``score`` in log10."""
    ready = counted(docs, learn, weigh, id_col, text_col)
    learned = F.col("part") > 0
    facts = ready.agg(
        F.count_if(learned).alias("docs"), F.sum(F.when(learned, F.col("n_tokens"))).alias("tokens"), F.sum("new_words").alias("words")
    ).first()
    ends, total, words = facts.docs, facts.tokens or 0, facts.words or 0
    weights = learn_weights(ready, words)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, base, model = [], [], []
            for k in range(batch.num_rows):
                word, pair = (_read(batch.column(x)[k].as_py()).astype(np.float64) for x in ("word", "pair"))
                bucket, f_pair, f_word = _estimates(word, pair, ends, total)
                w = weights[bucket]
                known.append(int((word > 0).sum()))
                base.append(float(np.log10(word + 1).sum()) - len(word) * math.log10(total + words + 1))
                model.append(float(np.log10(w[:, 0] * f_pair + w[:, 1] * f_word + w[:, 2] / (words + 1)).sum()))
            columns = [batch.column("doc_id"), batch.column("n_tokens"), pa.array(known, pa.int64()), pa.array([total] * len(known), pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(base, pa.float64()), pa.array(model, pa.float64())], names)

    names = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kind = ready.schema["doc_id"].dataType.simpleString()
    layout = f"doc_id {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return ready.select("doc_id", "n_tokens", "word", "pair").mapInArrow(run, layout)
