"""BPE against the public library that reads the same ranks."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from meterline.llm.bpe import Merger, RankQueue, decode, encode, rank_encoder, read_ranks

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = read_ranks(PATH)
PUBLIC = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = [
    "",
    " ",
    "\n",
    "a",
    "a\n",
    "\na",
    "  two  spaces ",
    "it's don't we'll I'd",
    "tabs\tand\r\nline ends\n\n\nmore \n x",
    "café naïve 你好 \U0001f600‍\U0001f600  x y",
    "\x1c\x1d x\x1e \x85y",
    "<|endoftext|> a",
    "x" * 5000,
    "ab" * 3000 + " " + "-" * 777,
    "1234567890" * 300,
    " lead and trail ",
    "a \nb",
    "a\n b",
]


def test_queue_pops_by_rank_then_position():
    queue, rng, held = RankQueue(5000), random.Random(1), []
    for _ in range(3000):
        if held and rng.random() < 0.4:
            assert queue.pop() == min(held)
            held.remove(min(held))
        else:
            pair = (rng.randrange(5000), rng.randrange(100))
            if pair not in held:
                held.append(pair)
                queue.push(*pair)
    while held:
        assert queue.pop() == min(held)
        held.remove(min(held))
    assert queue.pop() is None


def test_random_texts_equal_the_public_library():
    rng, encoder = random.Random(2), rank_encoder(RANKS, public_tokenizers.PATTERN)
    texts = ODD + ["".join(rng.choice("ab c\n\t 'és1. ") for _ in range(rng.randrange(60))) for _ in range(1500)]
    for text, ids in zip(texts, encoder.many(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == PUBLIC.encode_ordinary(text), repr(text)


def test_side_by_side_equals_one_by_one():
    rng, merger = random.Random(3), Merger(RANKS)
    pieces = ["".join(rng.choice("abcdethxn-é") for _ in range(rng.randrange(1, 40))).encode() for _ in range(3000)] + [b"aaaaaaaaaaaaaaaaaaaa", b"abababababab"]
    for piece, ids in zip(pieces, merger.encode_all(pieces)):
        assert PUBLIC.decode_bytes(np.frombuffer(ids, "<u4").tolist()) == piece
        if piece not in RANKS:
            assert np.frombuffer(ids, "<u4").tolist() == merger.encode(piece)


def test_long_pretoken():
    piece = ("abcabd" * 20000).encode()
    assert Merger(RANKS).encode(piece) == PUBLIC.encode_ordinary(piece.decode())


@pytest.mark.parametrize("rows", [[], [(i, t) for i, t in enumerate(ODD)] + [(None, None), (None, "x"), (3, "a"), (3, "a")]])
def test_frames(spark, rows):
    docs = spark.createDataFrame([(i, t, "c", [1]) for i, t in rows], "doc_id long, text string, ids string, decoded array<int>")
    got = decode(encode(docs, PATH, public_tokenizers.PATTERN), PATH).collect()
    assert sorted(encode(docs, PATH, public_tokenizers.PATTERN, with_decoded=True).collect(), key=str) == sorted(got, key=str)
    want = sorted(((i, PUBLIC.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows), key=lambda x: (str(x[0]), x[2]))
    assert sorted(((r.doc_id, list(r.ids), bytes(r.decoded)) for r in got), key=lambda x: (str(x[0]), x[2])) == want
