"""Decontamination against a comparison of every window of every document with every item."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from meterline.llm.decontaminate import blocks, contaminations, decontaminate


def shingles(words):
    return [tuple(words[k : k + 5]) for k in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] if words else []


def alike(a, b):
    x, y = Counter(a), Counter(b)
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def cut(text):
    return [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]


def brute(docs, items):
    found = set()
    for d, text in docs:
        words = cut(text)
        for i, item in items:
            target = cut(item)
            n = len(target)
            if n and words and max(alike(shingles(words[k : k + n]), shingles(target)) for k in range(max(1, len(words) - n + 1))) >= 0.8:
                found.add((d, i))
    return found


ITEM = "The quick brown fox jumps over the lazy dog while seven wizards quietly brew dark coffee under an old stone bridge tonight"
ITEMS = [(1, ITEM), (2, "Four words only here"), (3, None), (4, ""), (5, "a a a a a a a a a a a a"), (6, "one two three four five")]
FILL = " ".join(f"w{k}" for k in range(300))
DOCS = [
    (1, f"{FILL} {ITEM.upper()}! {FILL}"),
    (2, ITEM.replace("tonight", "today")),
    (3, ITEM.replace("wizards", "witches")),
    (4, "four words: only here"),
    (5, None),
    (6, ""),
    (7, "a " * 500),
    (None, f"x {ITEM} y"),
    (8, FILL),
    (9, "zero one two three four five six"),
    (9, ITEM),
    (9, ITEM),
    (10, ITEM[:60]),
    (11, FILL + " " + ITEM.replace("over ", "over and over ") + " " + FILL),
]


def frames(spark, docs, items):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, n_words int"), spark.createDataFrame(items, "item_id long, text string")


def test_equals_every_window(spark):
    docs, items = frames(spark, DOCS, ITEMS)
    got = contaminations(docs, items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(DOCS, ITEMS)
    assert len(got) == len({(r.doc_id, r.text_hash, r.item_id) for r in got})
    first = next(r for r in got if r.doc_id == 1)
    assert (first.begin, first.n_words, first.distance, first.similarity) == (300, len(ITEM.split()), 0, 1.0)
    kept = decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, t in DOCS if not brute([(d, t)], ITEMS))


@pytest.mark.parametrize("docs, items", [([], ITEMS), (DOCS, []), ([], [])])
def test_empty_tables(spark, docs, items):
    assert contaminations(*frames(spark, docs, items)).collect() == []


def test_fingerprints_within_the_radius_share_a_block(spark):
    import random

    rng = random.Random(0)
    rows = []
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for k in rng.sample(range(64), 20):
            b ^= 1 << k
        rows.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    pairs = spark.createDataFrame(rows, "a long, b long")
    shared = pairs.select(F.size(F.array_intersect(blocks(F.col("a")), blocks(F.col("b")))).alias("n"))
    assert shared.agg(F.min("n")).first()[0] >= 1


def test_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{folder}/{x}.parquet") for x in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in contaminations(docs, items).collect()}
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    known = [(r.item_id, r.text) for r in items.collect()]
    near = [(d, t) for d, t in texts if any(set(shingles(cut(t))) & set(shingles(cut(i))) for _, i in known)]
    assert got == brute(near, known)


def test_items_of_few_words_inside_longer_texts(spark):
    items = [*ITEMS, (7, "one"), (8, "two words"), (9, "three of them"), (9, "Zwei Wörter"), (10, "Three of THEM!"), (11, "w5 w6 w7 w8 w9")]
    rows = [
        (20, f"{FILL} four words only here {FILL}"),
        (21, "two words, two words and two words; one one " * 40),
        (22, "here are three of them"),
        (23, "Four words only. Here! Only"),
        (24, "four words only"),
        (25, "zwei wörter three of"),
        (26, "one"),
        (27, "two  words"),
        (28, "words two"),
    ]
    docs, known = frames(spark, DOCS + rows, items)
    got = contaminations(docs, known).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(DOCS + rows, items)
    assert {(20, 2), (21, 7), (21, 8), (22, 9), (22, 10), (23, 2), (25, 9), (26, 7), (27, 8)} <= {(r.doc_id, r.item_id) for r in got}
    where = {(r.doc_id, r.item_id): (r.begin, r.n_words, r.similarity) for r in got}
    assert where[20, 2] == (300, 4, 1.0) and where[21, 8] == (0, 2, 1.0) and where[25, 9] == (0, 2, 1.0)
