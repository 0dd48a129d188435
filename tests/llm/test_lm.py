"""Language scores against plain counting."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import lm
from meterline.llm.queries_lm import op9_lm


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def brute(rows, learn, weigh):
    """Base scores, and the model's with the weights given by an exact form of the same estimation."""
    pairs = lambda t: list(zip([None, *t[:-1]], t))
    train = [tokens(t) for i, t in rows if learn(i)]
    held = [tokens(t) for i, t in rows if learn(i) and weigh(i)]
    rest = [tokens(t) for i, t in rows if learn(i) and not weigh(i)]
    uni, bi = Counter(w for t in train for w in t), Counter(p for t in train for p in pairs(t))
    n, v = sum(uni.values()), len(uni)
    u, b = Counter(w for t in rest for w in t), Counter(p for t in rest for p in pairs(t))
    m = sum(u.values())
    bucket = lambda c: int(math.log2(c)) + 1 if c else 0
    estimates = lambda p, uni, bi, n: (bi[p] / max(1, uni[p[0]]), uni[p[1]] / max(1, n), 1 / (v + 1))
    weights = {k: (1 / 3, 1 / 3, 1 / 3) for k in range(lm.BUCKETS)}
    seen = [(bucket(u[p[0]]), estimates(p, u, b, m)) for t in held for p in pairs(t)]
    for _ in range(60 if seen else 0):
        sums = {k: np.full(3, 0.01) for k in weights}
        for k, e in seen:
            mixed = np.array(e) * weights[k]
            sums[k] += mixed / mixed.sum()
        weights = {k: s / s.sum() for k, s in sums.items()}
    out = []
    for i, text in rows:
        t = tokens(text)
        base = sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in t)
        model = sum(math.log10(np.dot(weights[bucket(uni[p[0]])], estimates(p, uni, bi, n))) for p in pairs(t))
        out.append((str(i), len(t), sum(uni[w] > 0 for w in t), n, base, model))
    return sorted(out)


def compare(got, want):
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    np.testing.assert_allclose([g[4] for g in got], [w[4] for w in want], rtol=1e-9)
    np.testing.assert_allclose([g[5] for g in got], [w[5] for w in want], rtol=0.01)


def rows_of(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("the a of dog cat É sees eats big red".split()) if rng.random() < 0.9 else f"w{rng.randrange(99)}"
    rows = [(k, " ".join(word() for _ in range(rng.randrange(30)))) for k in range(120)]
    return [*rows, (500, None), (501, " \t\n"), (502, "The THE the"), (502, "The THE the"), (503, "dog " * 4000)]


@pytest.mark.parametrize("blocks", [1, 7])
def test_equals_plain_counting(spark, monkeypatch, blocks):
    monkeypatch.setattr(lm, "block_count", lambda df, size: blocks)
    rows = rows_of(blocks)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, part int")
    got = lm.score(docs, F.col("doc_id") % 7 != 2, F.col("doc_id") % 7 == 4).collect()
    compare(got, brute(rows, lambda i: i % 7 != 2, lambda i: i % 7 == 4))


def test_rows_without_id_are_scored(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, "a b")], "doc_id long, text string")
    got = lm.score(docs, F.col("doc_id") == 1, F.lit(False)).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "None"] and len({r.score for r in got}) == 1


@pytest.mark.parametrize("rows", [[], [(1, "a b a"), (2, None)]])
def test_nothing_to_learn_from(spark, rows):
    got = lm.score(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(False), F.lit(False)).collect()
    compare(got, brute(rows, lambda i: False, lambda i: False))


def test_query_improves_on_the_base(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    part = lambda i: zlib.crc32(str(i).encode()) % 7
    got = op9_lm(spark, folder).collect()
    compare(got, brute(docs, lambda i: part(i) != 2, lambda i: part(i) == 4))
    assert all(r.held_out == (part(r.doc_id) == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_counts_beyond_32_bits():
    import numpy as np
    import pyarrow as pa

    from meterline.llm import lm
    from meterline.llm.packing import numbers, packed, read, unpacked

    for x in ([], [0], [7, 2**32 - 1], [2**32, 1], [2**52, 0, 3]):
        assert read(numbers(np.array(x, dtype=np.int64))).tolist() == x
    keys, many = np.array([5, 9], dtype=np.uint64), np.array([3 * 10**9, 1])
    asked = [(lm.WORD, 0, b, packed(keys), numbers(many), numbers(many * 0)) for b in (0, 1)]
    table = pa.table({n: [r[k] for r in asked] for k, n in enumerate(("kind", "range", "block", "keys", "train", "held"))})
    assert unpacked(asked[0][3]).tolist() == [5, 9]
    assert [read(t).tolist() for t in lm._answer(table).column("train").to_pylist()] == [[6 * 10**9, 2]] * 2
