"""Plane files: exact round trips, and ids against the public library."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from meterline.llm.planes import from_planes, read_ids, to_planes, write_ids
from meterline.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


@pytest.mark.parametrize("unit", ["bit", "byte"])
@pytest.mark.parametrize("ids", [[], [0], [7] * 9, [0, 50256, 1, 2**31 + 5], list(range(1000))])
def test_planes_round_trip(unit, ids):
    given = np.array(ids, dtype="<u4")
    assert from_planes(to_planes(given, unit), len(given), unit).tolist() == ids


def test_unknown_unit():
    with pytest.raises(ValueError):
        to_planes(np.array([1], dtype="<u4"), "nibble")


def expected(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    start, out = 0, []
    for doc_id, text in rows:
        ids = [*LIBRARY.encode(text, add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("unit", ["bit", "byte"])
@pytest.mark.parametrize("rows", [[], [(5, None), (2, ""), (2, "b"), (2, "b"), (None, "no id"), (9, "word " * 900), (1, "a\n\nb <|endoftext|>")]])
def test_files_read_back(spark, rows, unit):
    path = scratch_path(spark, "planes-test")
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, ids string, shard int")
    write_ids(docs, PATH, path, unit=unit, chunk_ids=64, bytes_a_shard=1 << 10)
    got = sorted((r.start, r.doc_id, r.n_tokens, zlib.crc32(r.ids)) for r in read_ids(spark, path).collect())
    assert [(d, s, n, c) for s, d, n, c in got] == expected(rows)


def test_words_side_by_side_equal_the_library():
    import random

    from meterline.llm.planes import library_encoder

    rng = random.Random(6)
    texts = ["", " ", "a", "<|endoftext|> x", "é\U0001f600 \U0001f600y", "it's don't\nI'll", "a\n\nb", "x  y", " lead", "trail ", "\x1c a", "tab\tbed word"]
    texts += ["".join(rng.choice("ab c\n\t 'és1. ") for _ in range(rng.randrange(60))) for _ in range(800)]
    texts += ["".join(rng.choice("ab \n") for _ in range(rng.randrange(12))) for _ in range(3000)]
    texts += [f"{a}<|endoftext|>{b}" for a in ("", "x", " ", "  ", "\n") for b in ("", "y", " y", "  ", "\n\n")]
    encoder = library_encoder(open(PATH, encoding="utf-8").read())
    for text, ids in zip(texts, encoder.many(pa.array(texts))):
        assert ids.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids, repr(text)
    assert encoder.many(pa.array([], pa.string())) == []


def test_special_strings_are_single_ids():
    from meterline.llm.planes import library_encoder

    ids = library_encoder(open(PATH, encoding="utf-8").read()).many(pa.array(["a <|endoftext|> b"]))[0]
    assert ids.tolist() == [64, 220, 50256, 275]


def test_query(spark):
    from meterline.llm.queries_planes import op5_planes

    folder = "/root/testdata/sf0.001"
    got = op5_planes(spark, folder)
    assert got.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    given = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.collect())) == sorted(expected(given))
