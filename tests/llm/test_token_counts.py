"""Token counts against the public libraries on whole texts."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from meterline.llm.queries_token_counts import op13_token_counts
from meterline.llm.token_counts import LONG_WORD, TokenCounter, by_bytes, count_tokens, drops_spaces, json_lengths

WORDS = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(WORDS)
FOLDER = "/root/testdata/sf0.001"


def plain(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def odd_texts():
    rng = random.Random(13)
    texts = ["", " ", "\n\t", "a", "It's don't I'LL we'Re x'd 'tis", "x<|endoftext|>y <|endoftext|> <|startoftext|>", "<| endoftext|> <|end\noftext|> <|ENDOFTEXT|>"]
    texts += ["é ́x ạ́b", "ΣΣ ΟΣ. İİ", "a\x1cb\x85c d e​f", "中文" * 3000, "1" * 9000, "1́" * 3000, "ab1" * 4000 + "<|endoftext|>" * 400]
    texts += ["a" * 30_000, "9<|endoftext|>" * 2000, "word " * 20_000, "x-1-ý" * 2000]
    texts += ["".join(rng.choice("ab cS\n\t 'és1.<|>́\U0001f600Ω") for _ in range(rng.randrange(80))) for _ in range(1500)]
    return texts


def test_words_equal_whole_texts():
    counter = TokenCounter(*json_lengths(open(WORDS, "rb").read()))
    assert counter.by_words
    texts = odd_texts()
    for text, n in zip(texts, counter.many(pa.array(texts))):
        assert n == plain(text), repr(text[:80])


def test_only_tokenizers_that_drop_white_space_are_cut():
    assert drops_spaces(LIBRARY)
    assert not drops_spaces(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))


def test_long_words_are_cut_behind_digits():
    word = "abc1" * LONG_WORD
    pieces = TokenCounter._cut(word)
    assert "".join(pieces) == word and max(map(len, pieces)) <= LONG_WORD + 4


def test_batches_are_balanced_by_bytes():
    words = ["é" * n for n in (3, 3, 3, 50, 1, 1)]
    batches = list(by_bytes(words, 12))
    assert [w for b in batches for w in b] == words
    assert [sum(len(w.encode()) for w in b) for b in batches] == [12, 6, 100, 4]


@pytest.mark.parametrize("rows", [[], [(5, None), (2, ""), (2, "b b"), (2, "b b"), (None, "no id"), (9, "word " * 5000)]])
def test_tables(spark, rows):
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, n_tokens int, over_limit string")
    got = count_tokens(docs, WORDS).collect()
    expected = [(i, len((t or "").encode()), plain(t), plain(t) > 2048) for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_other_vocabularies(spark, name):
    path = public_tokenizers.path(name)
    if name.endswith(".json"):
        whole = Tokenizer.from_file(path)
        count = lambda t: len(whole.encode(t, add_special_tokens=False).ids)
    else:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    texts = ["", "two  words", "it's\n\nodd <|endoftext|>", "é" * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in count_tokens(docs, path, limit=1).collect()} == {i: count(t) for i, t in enumerate(texts)}


def test_unknown_kind(spark):
    with pytest.raises(ValueError):
        count_tokens(spark.createDataFrame([(1, "a")], "doc_id long, text string"), "words.txt")


def test_query(spark):
    found = op13_token_counts(spark, FOLDER)
    assert found.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    given = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in found.collect()}
    assert got == {i: (len(t.encode()), plain(t), plain(t) > 2048) for i, t in given.items()}
