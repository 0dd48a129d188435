"""Token counts of whole texts, by the public libraries, without keeping a token.

Texts reach Python in Arrow batches, which are cut into portions of about the
same number of bytes. Where the tokenizer drops white space, so that no token
and no normalisation reaches over it, white space is a safe boundary: a portion
is split there in one Arrow pass, each distinct word is encoded once, and the
lengths are summed by document. Words of more than ``LONG_WORD`` characters are
split further behind an ASCII digit, where such a tokenizer splits as well.
Other tokenizers get their texts whole. What goes to the library is dealt into
batches of about ``BATCH_BYTES``, and only lengths come back.

Defined results: a null or empty text has 0 bytes and 0 tokens; rows with equal
ids, or without one, each have their own count; an empty table gives an empty
one; a text of any length is one row with its whole count (a run of letters
without white space or digits is encoded in one piece); columns other than the
two named ones are left behind.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.bpe import in_portions
from meterline.llm.common import texts
from meterline.llm.words import BATCH_BYTES, REMEMBERED, by_bytes

#: Bytes of text that are split and summed at a time.
PORTION_BYTES = 4 << 20
#: Words longer than this are cut further.
LONG_WORD = 1 << 12
ASCII_SPACES = "\t\n\v\f\r "
#: Behind a digit that another visible ASCII character follows: a digit is a match by itself.
BEHIND_DIGIT = re.compile(r"(?<=[0-9])(?=[!-~])")

Lengths = Callable[[list[str]], list[int]]


def drops_spaces(tokenizer) -> bool:
    """Whether white space only separates, so that texts can be cut there; digits stand alone too."""
    if tokenizer.pre_tokenizer is None or tokenizer.post_processor is not None:
        return False
    normalize = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str

    def pieces(text: str) -> list[str]:
        return [piece for piece, _ in tokenizer.pre_tokenizer.pre_tokenize_str(normalize(text))]

    apart = all(pieces(f"{s}a{s}{s}b.{s}") == ["a", "b", "."] for s in ASCII_SPACES) and pieces("a1-2b") == ["a", "1", "-", "2", "b"]
    spaced = any(set(ASCII_SPACES) & set(t.content) or t.lstrip or t.rstrip or t.single_word or re.search("[0-9]", t.content) for t in tokenizer.get_added_tokens_decoder().values())
    return apart and not spaced


def json_lengths(vocabulary: bytes) -> tuple[Lengths, bool]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary.decode())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    batch = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
    return lambda words: [len(x) for x in batch(words, add_special_tokens=False)], drops_spaces(tokenizer)


def model_lengths(vocabulary: bytes) -> tuple[Lengths, bool]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=vocabulary)
    return lambda words: [len(x) for x in model.encode(words, num_threads=1, add_bos=False, add_eos=False)], False


class TokenCounter:
    """Counts the tokens of many texts, whole or by their distinct words."""

    def __init__(self, lengths: Lengths, by_words: bool):
        self.lengths, self.by_words = lengths, by_words
        self.kept: dict[str, int] = {}

    def _encoded(self, words: list[str]) -> Iterator[int]:
        for batch in by_bytes(words):
            yield from self.lengths(batch)

    def _learn(self, words: list[str]) -> None:
        short = [w for w in words if len(w) <= LONG_WORD]
        self.kept.update(zip(short, self._encoded(short)))
        for word in words:
            if len(word) > LONG_WORD:
                self.kept[word] = sum(self._encoded(self._cut(word)))

    @staticmethod
    def _cut(word: str) -> list[str]:
        """The word in pieces of about ``LONG_WORD`` characters that end at a safe boundary."""
        pieces, start = [], 0
        for place in (m.start() for m in BEHIND_DIGIT.finditer(word)):
            if place - start >= LONG_WORD:
                pieces.append(word[start:place])
                start = place
        return [*pieces, word[start:]]

    def many(self, column: pa.Array) -> np.ndarray:
        if not self.by_words:
            return np.fromiter(self._encoded(column.to_pylist()), np.int64, len(column))
        split = pc.ascii_split_whitespace(column)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        self._learn([w for w in words if w not in self.kept])
        each = np.fromiter(map(self.kept.__getitem__, words), np.int64, len(words))
        before = np.concatenate([[0], np.cumsum(each[coded.indices.to_numpy(zero_copy_only=False)])])
        ends = np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy(zero_copy_only=False))])
        while len(self.kept) > REMEMBERED:
            self.kept.popitem()  # the latest, and so rarest, go first
        return np.diff(before[ends])


_counters: dict[str, TokenCounter] = {}


def count_tokens(
    docs: DataFrame, vocabulary_path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of each whole text.

    A ``.json`` vocabulary is read by the tokenizers library, a ``.model`` by
    sentencepiece. No begin, end or added special token is counted; special
    strings inside texts are what the library takes them for. The vocabulary
    travels in a broadcast; its size is fixed.
    """
    makers = {".json": json_lengths, ".model": model_lengths}
    make = makers.get(os.path.splitext(vocabulary_path)[1])
    if make is None:
        raise ValueError(f"a vocabulary ends with one of {sorted(makers)}, not {vocabulary_path!r}")
    with open(vocabulary_path, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    source = texts(docs, id_col, text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary_path not in _counters:  # one per Python worker, so that its words serve all tasks
            _counters[vocabulary_path] = TokenCounter(*make(shared.value))
        counter = _counters[vocabulary_path]
        for batch in batches:
            for part in in_portions(batch, "text", PORTION_BYTES):
                text = part.column("text")
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": part.column("doc_id"), "n_bytes": pc.binary_length(text).cast(pa.int64()), "n_tokens": pa.array(counter.many(text), pa.int64())}
                )

    kind = source.schema["doc_id"].dataType.simpleString()
    counts = source.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
