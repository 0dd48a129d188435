"""Language labels for words by a linear-chain conditional random field.

A word's score for each language is the sum of the weights of its character
n-grams (those that touch its ends are its affixes) and of the word itself
(the lexicon); learned transitions join neighbours. Forward-backward gives
each word's distribution; a document takes the language with the largest mean.
Words of more than ``LONGEST_PIECE`` letters, as in scripts without spaces, are
cut into consecutive pieces, each of which is labelled and counted as a word.

Training uses at most ``docs_a_language`` documents of each language (a sample
by a hash of the id), of each ``sample_chars`` characters from a place that
the hash chooses, spliced into sequences that switch language. Prediction
uses every letter of every word of every text.

Defined results: a null text or one without a letter is ``und`` with score 0
and no runs; so is every text if no labelled row can be learned from; rows
without an id or a language are not learned from, all rows are predicted, one
by one; of equally likely languages the first in order of name is taken;
columns other than those named are left behind.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.bpe import in_portions
from meterline.llm.common import texts

UNKNOWN = "und"
BUCKETS = 1 << 16
LONGEST = 4  # of the n-grams
#: Letters of a word that is not cut.
LONGEST_PIECE = 32
#: So many words' scores are kept by a Python worker before it starts afresh.
REMEMBERED = 400_000


def letters(word: str) -> str:
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def pieces(words: list[str]) -> list[str]:
    """The words, with those of more letters than ``LONGEST_PIECE`` cut into the fewest pieces, about equally long."""
    if max(map(len, words), default=0) <= LONGEST_PIECE:
        return words
    found: list[str] = []
    for word in words:
        bare = letters(word) if len(word) > LONGEST_PIECE else word
        n = -(-len(bare) // LONGEST_PIECE)
        found += [bare[len(bare) * k // n : len(bare) * (k + 1) // n] for k in range(n)] if n > 1 else [word]
    return found


def feature_buckets(words: list[str]) -> np.ndarray:
    """The weights' rows for each word; row ``BUCKETS`` stands for no feature."""
    width = max(map(len, words), default=0) + 2
    chars = np.array([f"^{w}$" for w in words], dtype=f"<U{width}").view(np.uint32).reshape(len(words), width).astype(np.uint64)
    there = chars > 0
    with np.errstate(over="ignore"):
        spread = lambda h: ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(BUCKETS)
        found = []
        grams, whole = np.zeros_like(chars), np.zeros(len(words), dtype=np.uint64)
        for n in range(1, LONGEST + 1):
            grams = grams[:, : width - n + 1] * np.uint64(1_000_003) + chars[:, n - 1 :] + np.uint64(n)
            found.append(np.where(there[:, n - 1 :], spread(grams), np.uint64(BUCKETS)))
        for k in range(width):
            whole = np.where(there[:, k], whole * np.uint64(16_777_619) ^ chars[:, k], whole)
    return np.hstack([*found, spread(whole + np.uint64(99))[:, None]]).astype(np.int64)


@dataclass
class Chain:
    """Weights of the features and of the transitions, for languages in order of name."""

    languages: list[str]
    weights: np.ndarray  # (BUCKETS + 1, languages)
    transitions: np.ndarray

    def scores(self, words: list[str]) -> np.ndarray:
        parts = [self.weights[feature_buckets(words[k : k + 4096])].sum(axis=1) for k in range(0, len(words), 4096)]
        return np.vstack(parts) if parts else np.zeros((0, len(self.languages)), np.float32)

    def marginals(self, scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray | None = None) -> np.ndarray:
        """Each word's distribution; ``scores`` has the words of sequence after sequence.

        The expected numbers of transitions are added to ``moves``.
        """
        place, counts = packed(lengths)
        there = np.exp(scores - scores.max(axis=1, keepdims=True))
        emitted = np.empty_like(there)
        emitted[place] = there
        move = np.exp(self.transitions - self.transitions.max()).astype(there.dtype)
        starts = np.concatenate([[0], np.cumsum(counts)])
        forward = np.empty_like(emitted)
        for t, n in enumerate(counts):
            now = emitted[starts[t] : starts[t] + n]
            if t:
                now = now * (forward[starts[t - 1] : starts[t - 1] + n] @ move)
            forward[starts[t] : starts[t] + n] = now / now.sum(axis=1, keepdims=True)
        backward = np.ones_like(emitted)
        for t in range(len(counts) - 2, -1, -1):
            n = counts[t + 1]
            later = slice(starts[t + 1], starts[t + 1] + n)
            coming = backward[later] * emitted[later]
            if moves is not None:
                pairs = forward[starts[t] : starts[t] + n, :, None] * move * coming[:, None, :]
                moves += (pairs / pairs.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            now = coming @ move.T
            backward[starts[t] : starts[t] + n] = now / now.sum(axis=1, keepdims=True)
        both = forward * backward
        return (both / both.sum(axis=1, keepdims=True))[place]


def packed(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word goes if words are laid out position by position, the longest sequence first; words a position."""
    order = np.argsort(-lengths, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(lengths))
    counts = np.searchsorted(np.sort(lengths), np.arange(lengths.max(initial=0)), side="right")
    counts = len(lengths) - counts
    position = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.concatenate([[0], np.cumsum(counts)])[position] + np.repeat(rank, lengths), counts


def spliced(samples: dict[str, list[list[str]]], languages: list[str], sequences: int, length: int, seed: int) -> Iterator[tuple[list[str], np.ndarray]]:
    """Sequences that take stretches of words from the samples, half of them switching language within."""
    rng = np.random.default_rng(seed)
    for _ in range(sequences):
        words: list[str] = []
        gold: list[int] = []
        mixed, k = rng.random() < 0.5, int(rng.integers(len(languages)))
        while len(words) < length:
            if mixed:
                k = int(rng.integers(len(languages)))
            text = samples[languages[k]][rng.integers(len(samples[languages[k]]))]
            n = int(rng.integers(4, 24)) if mixed else length
            at = int(rng.integers(max(1, len(text) - n + 1)))
            words += text[at : at + n]
            gold += [k] * len(text[at : at + n])
        yield words[:length], np.array(gold[:length])


def fit(samples: dict[str, list[list[str]]], sequences: int = 4000, length: int = 48, batch: int = 50, rate: float = 0.15, seed: int = 3) -> Chain:
    """Likelihood gradients (expected less observed counts) in steps scaled as by AdaGrad."""
    languages = sorted(k for k, texts in samples.items() if any(texts))
    samples = {k: [x for x in samples[k] if x] for k in languages}
    size = len(languages)
    chain = Chain(languages, np.zeros((BUCKETS + 1, size), np.float32), np.zeros((size, size), np.float32))
    if size < 2:
        return chain
    squares, move_squares = np.full((BUCKETS + 1, size), 1e-2, np.float32), np.full((size, size), 1e-2)
    rows = list(spliced(samples, languages, sequences, length, seed))
    for first in range(0, len(rows), batch):
        part = rows[first : first + batch]
        words, gold = [w for ws, _ in part for w in ws], np.concatenate([g for _, g in part])
        buckets = feature_buckets(words)
        expected = np.zeros((size, size))
        p = chain.marginals(chain.weights[buckets].sum(axis=1), np.full(len(part), length), expected)
        wrong = p.copy()
        wrong[np.arange(len(gold)), gold] -= 1
        flat = buckets.ravel()
        slope = np.stack([np.bincount(flat, np.repeat(wrong[:, k], buckets.shape[1]), BUCKETS + 1) for k in range(size)], axis=1) / len(gold)
        slope[BUCKETS] = 0
        squares += slope**2
        chain.weights -= (rate * slope / np.sqrt(squares)).astype(np.float32)
        inner = np.arange(len(gold)).reshape(len(part), length)
        here, after = inner[:, :-1].ravel(), inner[:, 1:].ravel()
        seen = np.zeros((size, size))
        np.add.at(seen, (gold[here], gold[after]), 1)
        slope = (expected - seen) / len(gold)
        move_squares += slope**2
        chain.transitions -= (rate * slope / np.sqrt(move_squares)).astype(np.float32)
    return chain


def train(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    docs_a_language: int = 300,
    sample_chars: int = 3000,
) -> Chain:
    """``learn`` is a condition on ``doc_id``; see the module for what is sampled."""
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))
    rows = rows.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").where(learn)
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row a language
    if not counts:
        return Chain([], np.zeros((BUCKETS + 1, 0), np.float32), np.zeros((0, 0), np.float32))
    chance = F.lit(0.0)
    for lang, n in counts.items():
        chance = F.when(F.col("lang") == lang, min(1.0, docs_a_language / n)).otherwise(chance)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    begin = F.greatest(F.lit(0), F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.greatest(F.lit(1), F.length("text") - sample_chars)))
    part = F.substring(F.col("text"), (begin + 1).cast("int"), F.lit(sample_chars)).alias("part")
    samples: dict[str, list[list[str]]] = {k: [] for k in counts}
    for row in rows.where(draw < chance * (1 << 20)).select("lang", part, F.xxhash64("doc_id").alias("h")).orderBy("h").collect():
        samples[row.lang].append(pieces([x for w in row.part.lower().split() if (x := letters(w))]))
    return fit(samples)


class WordScores:
    """The scores of words met so far; row 0 is that of words without letters."""

    def __init__(self, chain: Chain):
        self.chain = chain
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1, len(self.chain.languages)), np.float32)

    def lookup(self, words: list[str]) -> np.ndarray:
        got = list(map(self.rows.get, words))
        if None in got:
            if len(self.rows) > REMEMBERED:
                self.forget()
            new = list(dict.fromkeys(w for w in words if w not in self.rows))
            bare = list(map(letters, new))  # no longer than a piece
            spelled = [k for k, w in enumerate(bare) if w]
            at = np.zeros(len(new), dtype=np.int64)
            at[spelled] = np.arange(len(self.table), len(self.table) + len(spelled))
            self.table = np.vstack([self.table, self.chain.scores([bare[k] for k in spelled])])
            self.rows.update(zip(new, at.tolist()))
            got = list(map(self.rows.__getitem__, words))
        return np.array(got, dtype=np.int64)


def label(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score``, and ``runs``: how many words in a row have which language."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    source = texts(docs, id_col, text_col)
    run_type = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32())]))
    languages = [*chain.languages, UNKNOWN]

    def portion(scores: WordScores, texts: list[str]) -> tuple[list[str], np.ndarray, list[list[dict]]]:
        words = [pieces(t.lower().split()) for t in texts]
        lengths = np.array([len(x) for x in words])
        row = scores.lookup([w for x in words for w in x])
        spelled = row > 0
        doc = np.repeat(np.arange(len(texts)), lengths)
        p = shared.value.marginals(scores.table[row], lengths) if len(row) and len(languages) > 2 else np.ones((len(row), len(languages) - 1))
        n = np.bincount(doc[spelled], minlength=len(texts))
        mean = np.stack([np.bincount(doc[spelled], p[spelled, k], len(texts)) for k in range(p.shape[1])] or [np.zeros(len(texts))], axis=1) / np.maximum(n, 1)[:, None]
        known = (n > 0) & (len(languages) > 1)
        best = np.where(known, mean.argmax(axis=1), len(languages) - 1)
        score = np.where(known, np.clip(mean.max(axis=1), 0, 1), 0.0)
        runs: list[list[dict]] = [[] for _ in texts]
        if len(languages) > 1 and len(row):
            top = p.argmax(axis=1)
            cut = np.flatnonzero(np.concatenate([[True], (top[1:] != top[:-1]) | (doc[1:] != doc[:-1])]))
            for d, k, m in zip(doc[cut].tolist(), top[cut].tolist(), np.diff(np.append(cut, len(row))).tolist()):
                if known[d]:
                    runs[d].append({"lang": languages[k], "words": m})
        return [languages[k] for k in best], score, runs

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = WordScores(shared.value)
        for batch in batches:
            for part in in_portions(batch, "text"):
                names, score, runs = portion(scores, part.column("text").to_pylist())
                columns = [part.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(runs, run_type)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "runs"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, runs array<struct<lang: string, words: int>>")
