"""Hard negatives against plain sorting with Python's integers, and the query against its SQL."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import difference
from meterline.llm import hard_negatives as hn
from meterline.llm.hard_negatives import best_first, hard_negatives, window_of
from meterline.llm.queries_hard_negatives import ORACLE, op12_hard_negatives
from meterline.llm.residues import exact_product, primes_for, residues

SCHEMA = "vec_id long, embedding array<float>, label int, anchor long, score string, block int"


@pytest.mark.parametrize("top, width", [(0, 3), (1, 1), (146, 64), (40_000, 7), (2**25, 2000), (2**20, 0)])
def test_products_are_exact(top, width):
    rng = np.random.default_rng(top + width)
    left, right = (rng.integers(-top, top + 1, (n, width)) for n in (5, 9))
    left[0], right[0], right[1] = top, top, -top
    primes = primes_for(width * top * top, width)
    got = exact_product(residues(left, primes), residues(right, primes), primes)
    assert got.tolist() == [[sum(int(x) * int(y) for x, y in zip(a, b)) for b in right] for a in left]
    assert len(set(primes)) == len(primes) and math.prod(primes) > 2 * width * top * top


@pytest.mark.parametrize("bound", [50, 1 << 61])
def test_best_first_by_place(bound):
    rng = np.random.default_rng(3)
    scores = rng.integers(-5, 6, (40, 33))
    wanted = rng.random(scores.shape) < 0.4
    for most in (1, 6, 33):
        found, places = best_first(scores, wanted, most, bound)
        for k in range(len(scores)):
            expected = sorted((-s, j) for j, s in enumerate(scores[k]) if wanted[k, j])[:most]
            assert [(-s, j) for s, j in zip(found[k], places[k]) if s > hn.NONE] == expected


def brute(rows, positives=5, negatives=10):
    kept = []
    for vec_id, vector, label, *_ in rows:
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    order = lambda x: (-x[1], x[0] is None, x[0] or 0)
    out = []
    for a in (k for k in kept if k[0] is not None and k[0] % 100 == 0):
        scored = [(b[0], sum(x * y for x, y in zip(a[1], b[1])), b[2]) for b in kept if b is not a]
        for p in sorted((s for s in scored if s[2] == a[2]), key=order)[:positives]:
            fit = [s for s in scored if s[2] != a[2] and 30 * p[1] <= 100 * s[1] <= 90 * p[1]]
            out += [(a[0], p[0], k + 1, s[0], p[1], s[1]) for k, s in enumerate(sorted(fit, key=order)[:negatives])]
    return out


def planted(n, seed, width=6):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.4) for _ in range(width)], rng.randrange(3)) for i in range(n)]
    same = [0.25] * width
    rows += [(1000 + i, same, rng.randrange(3)) for i in range(150)]  # a common vector: ties, an anchor among them
    rows += [(200, rows[200][1], rows[200][2])] * 2 + [(300, [0.5] * width, 1), (None, same, 0), (None, same, 1)]
    rows += [(5000, None, 1), (5100, same, None), (5200, [math.nan] * width, 1), (5300, [math.inf] * width, 2), (5400, [None, 1.0], 2)]
    rows += [(6000, [0.3, 0.3], 1), (6100, [], 2), (6200, [30_000.0, -9.0], 0)]
    return [(*r, 9, "x", 4) for r in rows]


@pytest.mark.parametrize("blocks", [(4096, 2048, 16, 256), (16, 3, 1, 2)])
def test_equals_plain_sorting(spark, monkeypatch, blocks):
    for name, value in zip(("ROWS_A_BLOCK", "ANCHORS_A_BLOCK", "BLOCKS_A_WAVE", "ANCHORS_AT_ONCE"), blocks):
        monkeypatch.setattr(hn, name, value)
    if blocks[0] == 16:
        monkeypatch.setattr(hn, "BYTES_A_TASK", 4096)
    rows = planted(420, 12)
    table = spark.createDataFrame(rows, SCHEMA)
    got = hard_negatives(table, F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(rows), key=str)


def test_empty_tables_and_no_anchors(spark):
    for rows in ([], planted(250, 1)):
        assert hard_negatives(spark.createDataFrame(rows, SCHEMA), F.lit(False)).count() == 0


def test_scores_beyond_62_bits_are_refused(spark):
    with pytest.raises(OverflowError):
        hard_negatives(spark.createDataFrame([(100, [3e9], 1, 0, "", 0)], SCHEMA), F.col("vec_id") == 100)


@pytest.mark.parametrize("score", [-7, 0, 1, 9, 10, 101, 2**61])
def test_windows(score):
    low, high = window_of(score, 30, 90)
    fits = lambda x: 30 * score <= 100 * x <= 90 * score
    assert all(fits(x) == (low <= x <= high) for end in (low, high) for x in range(end - 3, end + 4))


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    got = op12_hard_negatives(spark, folder)
    assert got.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]
    assert difference(got.toPandas(), connection.execute(ORACLE["op12_hard_negatives"]).df()) is None
