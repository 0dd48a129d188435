"""The chain against sums over all labellings; documents against planted languages."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm.langid import BUCKETS, LONGEST_PIECE, Chain, fit, label, letters, pieces, train


def test_marginals_equal_the_sum_over_all_labellings():
    rng = np.random.default_rng(0)
    chain = Chain(["a", "b", "c"], np.zeros((BUCKETS + 1, 3), np.float32), rng.normal(size=(3, 3)))
    lengths = np.array([1, 4, 3, 0, 5])
    scores = rng.normal(size=(lengths.sum(), 3))
    moves = np.zeros((3, 3))
    got, first, want_moves = chain.marginals(scores, lengths, moves), 0, np.zeros((3, 3))
    for n in lengths:
        part, total, want, pairs = scores[first : first + n], 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            weight = np.exp(sum(part[t, k] for t, k in enumerate(path)) + sum(chain.transitions[a, b] for a, b in zip(path, path[1:])))
            total += weight
            for t, k in enumerate(path):
                want[t, k] += weight
            for a, b in zip(path, path[1:]):
                pairs[a, b] += weight
        if n:
            np.testing.assert_allclose(got[first : first + n], want / total, rtol=1e-6)
            want_moves += pairs / total
        first += n
    np.testing.assert_allclose(moves, want_moves, rtol=1e-6)


def test_code_switching_is_found_and_transitions_stay():
    rng = np.random.default_rng(1)
    word = lambda parts: "".join(rng.choice(parts, 3))
    samples = {"x": [[word(["ka", "ko", "ki"]) for _ in range(60)] for _ in range(20)], "y": [[word(["lem", "lum", "lo"]) for _ in range(60)] for _ in range(20)]}
    chain = fit(samples, sequences=400)
    words = samples["x"][0][:20] + samples["y"][0][:20]
    p = chain.marginals(chain.scores(words), np.array([40]))
    assert p.argmax(axis=1).tolist() == [0] * 20 + [1] * 20
    assert (np.diag(chain.transitions) > chain.transitions[[0, 1], [1, 0]]).all()


def test_letters():
    assert [letters(x) for x in ("abc", "a1b!", "12", "é²")] == ["abc", "ab", "", "é"]


@pytest.mark.parametrize("lang", [None, "x"])
def test_without_labels_or_with_one_language(spark, lang):
    docs = spark.createDataFrame([(1, "kakoki koki", lang), (2, None, lang), (3, " 12 ! ", lang), (None, "ka", lang)], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in label(docs, train(docs, F.lit(True))).collect()}
    want = ("und", 0.0) if lang is None else ("x", 1.0)
    assert got == {1: want, 2: ("und", 0.0), 3: ("und", 0.0), None: want}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, runs int")
    assert label(docs, train(docs, F.lit(True))).collect() == []


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    even = F.col("doc_id") % 2 == 0
    got = label(docs, train(docs, even)).join(docs, "doc_id").where(~even).toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.97
    assert got.score.between(0, 1).all()
    assert (got.runs.map(lambda r: sum(x["words"] for x in r)) == got.text.str.split().map(len)).all()


def test_pieces():
    long = "".join(chr(0x4E00 + k) for k in range(1000))
    for word in ("a" * 33, "b" * 64, long, f"1{long}!2{long}"):
        got = pieces(["x", word, "12" * 40])
        assert got[0] == "x" and got[-1] == "12" * 40 and "".join(got[1:-1]) == letters(word)
        assert all(LONGEST_PIECE // 2 <= len(x) <= LONGEST_PIECE for x in got[1:-1])
    kept = ["", "a" * 32, "12" * 40, "1-" * 40 + "a" * 32]
    assert pieces(kept) == kept and pieces([]) == []


def test_every_letter_of_a_text_without_spaces_counts(spark):
    rng = np.random.default_rng(2)
    word = lambda parts, n=200: "".join(rng.choice(parts, n))
    x, y = ["ka", "ko", "ki"], ["lem", "lum", "lo"]
    chain = fit({k: [pieces([word(v)]) for _ in range(20)] for k, v in (("x", x), ("y", y))}, sequences=400)
    rows = [(1, word(x, 20) + word(y, 900) + word(x, 20)), (2, word(y, 20) + word(x, 900) + word(y, 20)), (3, word(x))]
    got = {r.doc_id: r for r in label(spark.createDataFrame(rows, "doc_id long, text string"), chain).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3)] == ["y", "x", "x"]
    assert [x.lang for x in got[1].runs] == ["x", "y", "x"] and got[1].score < 1
