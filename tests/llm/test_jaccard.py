"""The Jaccard join against a comparison of all pairs."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterline.llm.components import components
from meterline.llm import jaccard
from meterline.llm.common import BATCH_BYTES, BATCH_CONF, kept_by_worker, small_batches
from meterline.llm.jaccard import Measure, _describe, _near, link


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, measure=Measure()):
    rows = [(i, shingles(t, measure.words)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (a, x) in enumerate(rows):
        for b, y in rows[:k]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= measure.percent * len(x | y):
                low, high = sorted((top(a), top(b)))
                parent[high] = low
    return sorted(((str(i), len(x), None if i is None else top(i)) for i, x in rows), key=str)


def got(df):
    return sorted(((str(r.doc_id), r.n_shingles, r.component_id) for r in df.collect()), key=str)


def corpus(rng, families, chance):
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(4))
    rows, k = [], 100
    for _ in range(families):
        words = [word() for _ in range(rng.randrange(8, 120))]
        for _ in range(rng.randrange(1, 9)):
            words = [word() if rng.random() < chance else w for w in words]  # copies of copies
            rows.append((k, " ".join(words)))
            k += 1
    rng.shuffle(rows)
    return rows


EDGES = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO"), (6, "one two three"), (7, "É a b c d"), (8, "é a b c d"), (9, "x " * 3000), (10, "x " * 4), (None, "one two"), (11, "p q r s t"), (11, "k l m n o"), (12, "k l m n o"), (13, "p q r s t"), (13, "p q r s t")]


@pytest.mark.parametrize("seed, chance", [(1, 0.01), (2, 0.03)])
def test_families_of_copies(spark, seed, chance):
    rows = EDGES + corpus(random.Random(seed), 25, chance)
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, n string, token int").repartition(3)
    assert got(link(docs)) == brute(rows)


def test_empty_table(spark):
    assert link(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1040)] + [(2000, k) for k in range(1500, 1600)]
    parent = {n: n for p in pairs for n in p if p[0] != p[1]}
    for _ in range(300):
        for a, b in pairs:
            if a != b:
                parent[a] = parent[b] = min(parent[a], parent[b])
    found = components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == parent and found.count() == len(parent)


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got(link(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert link(docs).where(F.col("doc_id") != F.col("component_id")).count() > 0


def test_texts_go_only_to_pairs_whose_histograms_allow_a_link(spark):
    rng = random.Random(5)
    base = [str(rng.randrange(10**6)) for _ in range(400)]
    near, far = [*base[:-20], *map(str, range(20))], [*base[:200], *(str(rng.randrange(10**6)) for _ in range(200))]
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far)), (4, "one two three four five"), (4, " ".join(base))]
    sets = _describe(spark.createDataFrame(rows, "doc_id bigint, text string"), Measure()).where("n > 0")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (1, 4)], "hub bigint, member bigint")
    assert sorted(map(tuple, _near(pairs, sets, 85).collect())) == [(1, 2), (1, 4)]


def test_a_worker_keeps_the_latest_operator_alone():
    first = kept_by_worker("a", list)
    assert kept_by_worker("a", list) is first
    kept_by_worker("b", list)
    assert kept_by_worker("a", list) is not first


def test_rows_go_to_python_in_small_batches(spark, monkeypatch):
    seen, before = [], spark.conf.get(BATCH_CONF)
    monkeypatch.setattr(jaccard, "_linked", lambda every, *_: seen.append(every.sparkSession.conf.get(BATCH_CONF)))
    link(spark.createDataFrame([], "doc_id long, text string"))
    assert seen == [str(BATCH_BYTES)] and spark.conf.get(BATCH_CONF) == before
    wide = spark.range(0, 100, 1, 1).selectExpr("repeat('x', 100000) AS text")
    sizes = lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches)
    with small_batches(spark):
        rows = [r.n for r in wide.mapInArrow(sizes, "n bigint").collect()]
    assert sum(rows) == 100 and max(rows) <= BATCH_BYTES // 100_000 + 1
    spark.conf.set(BATCH_CONF, "1k")
    with small_batches(spark):  # what the session says is not raised
        assert spark.conf.get(BATCH_CONF) == "1024"
    spark.conf.set(BATCH_CONF, before)
