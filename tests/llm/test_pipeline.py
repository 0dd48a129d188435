"""The pipeline's stages, each against brute force on its own input."""

import hashlib
import re

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from meterline.llm import stages
from meterline.llm.bpe import read_ranks
from meterline.llm.jaccard import Measure
from meterline.llm.secrets import RULES
from test_decontaminate import brute as contaminated
from test_jaccard import brute as linked

FOLDER = "/root/testdata/sf0.001"
PUBLIC = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={}
)


@pytest.fixture(scope="module")
def kept(spark):
    """What comes in and what each stage makes of it."""
    docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(stages.stored(stage(spark, docs[-1], FOLDER), "stage"))
    return [d.collect() for d in docs]


def test_columns_and_whole_rows(kept):
    first = {r.doc_id: r for r in kept[0]}
    for rows in kept[1:5]:
        assert rows[0].__fields__ == list(stages.DOCUMENT)
    for rows in kept[1:4]:
        assert all(r == first[r.doc_id] for r in rows) and len({r.doc_id for r in rows}) == len(rows)


def test_quality_keeps_the_good(spark, kept):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    stay = {r.doc_id for r in kept[1]}
    right = [(d in stay) == bool(q) for d, q in labels.items()]
    assert sum(right) / len(right) > 0.95


def test_one_of_each_group_stays(kept):
    groups = linked([(r.doc_id, r.text) for r in kept[1]], Measure(5, 80))
    assert {str(r.doc_id) for r in kept[2]} == {i for i, _, component in groups if i == str(component)}


def test_contaminated_go(spark, kept):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    shingled = lambda t: {tuple(w[k : k + 5]) for w in [re.findall(r"[^\W_]+", t.lower())] for k in range(len(w) - 4)}
    known = set().union(*(shingled(t) for _, t in items))
    near = [(r.doc_id, r.text) for r in kept[2] if shingled(r.text) & known]
    gone = {d for d, _ in contaminated(near, items)}
    assert {r.doc_id for r in kept[3]} == {r.doc_id for r in kept[2]} - gone


def test_secrets_are_replaced(kept):
    before = {r.doc_id: r for r in kept[3]}
    assert len(kept[4]) == len(kept[3])
    for r in kept[4]:
        secret = [m for x in RULES for m in re.finditer(x.pattern, before[r.doc_id].text, re.ASCII) if len(m[x.group]) >= x.least]
        assert (r.text != before[r.doc_id].text) == bool(secret)
        assert r.n_chars == len(r.text) and not any(m[0] in r.text for m in secret)


def test_ids(kept):
    text = {r.doc_id: r.text for r in kept[4]}
    for r in kept[5]:
        ids = PUBLIC.encode_ordinary(text[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
    assert len(text) == len(kept[5])


def test_odd_rows(spark):
    """Nulls in every column, empty texts, repeated rows, equal ids, further columns, an empty table."""
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "token=abcdef", "en", "s", 12), (3, "token=abcdef", "en", "s", 12)]
    rows += [(None, "x y", None, None, 3), (4, "one two", "en", "s", 7), (4, "three four", "en", "s", 10)]
    layout = "doc_id long, text string, lang string, source string, n_chars long"
    for given in (rows, []):
        docs = spark.createDataFrame([(*r, 1, "c") for r in given], layout + ", score int, spans string")
        for _, stage in corpus_pipeline.STAGES[:4]:
            out = stage(spark, docs, FOLDER)
            assert out.columns == list(stages.DOCUMENT) and out.count() <= len(given)
        assert corpus_pipeline.STAGES[4][1](spark, docs, FOLDER).count() == len(given)
    docs = spark.createDataFrame(rows, layout)
    one = stages.keep_one_of_copies(spark, docs, FOLDER).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in one) == [("1", "None"), ("2", ""), ("3", "token=abcdef"), ("4", "one two"), ("4", "three four"), ("None", "x y")]
    clean = stages.redact_secrets(spark, docs, FOLDER).collect()
    assert sorted((str(r.doc_id), str(r.text), r.n_chars) for r in clean)[2:4] == [("3", "[SECRET]", 8)] * 2 and len(clean) == 7


def test_rows_with_unclear_ids_are_compared_as_rows(spark):
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(4, base), (4, "something else altogether"), (None, base + " more"), (None, "of no id"), (None, "of no id"), (9, base), (2, "unlike " + base.upper()), (5, None), (5, None), (6, "")]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((str(r.doc_id), str(r.text)) for r in stages.keep_one_of_copies(spark, docs, FOLDER).collect())
    assert got == sorted([("2", "unlike " + base.upper()), ("4", "something else altogether"), ("None", "of no id"), ("5", "None"), ("6", "")])


def test_each_row_is_scored_by_its_own_text(spark):
    good = [r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    texts = [next(r.text for r in good if labels.get(r.doc_id) == quality and len(r.text) > 200) for quality in (1, 0)]
    odd = spark.createDataFrame([(None, t, "en", "s", 1) for t in texts] + [(10**9, t, "en", "s", 1) for t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").unionByName(odd)
    stay = stages.keep_good(spark, docs, FOLDER).where("doc_id IS NULL OR doc_id = 1000000000").collect()
    assert sorted((r.doc_id is None, r.text) for r in stay) == [(False, texts[0]), (True, texts[0])]
