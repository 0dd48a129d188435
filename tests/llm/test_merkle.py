"""Merkle fingerprints against a plain form of the same tree."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from meterline.llm import merkle
from meterline.llm.merkle import PARAGRAPH, edit_with_next, edited_branches, fingerprints, likeness
from meterline.llm.queries_merkle import op8_merkle

md5 = lambda s: hashlib.md5(s.encode()).hexdigest()


def leaves(text):
    return [md5(m[0])[:12] for m in re.finditer(PARAGRAPH, text)]


def mark(text):
    tree = "".join(x + (";" if x[0] == "0" else ",") for x in leaves(text)).rstrip(",;")
    return hashlib.sha256("".join(md5(s) for s in tree.split(";")).encode()).hexdigest() + ":" + tree


def like(a, b):
    x, y = set(leaves(a)), set(leaves(b))
    return 1.0 if mark(a) == mark(b) else 2 * len(x & y) / max(1, len(x) + len(y))


def brute(rows):
    """For rows with distinct ids."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        q = len(text) // 4
        edited = text[: len(text) - q] + following[:q]
        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), mark(text), mark(edited), like(text, edited), like(text, following))
    return out


def result(df):
    return {r.doc_id: (r.n_chars, hashlib.sha256(r.edited.encode()).hexdigest(), r.fingerprint, r.edited_fingerprint, r.a, r.b) for r in df.collect()}


def compared(docs, **more):
    f, e, n = F.col("fingerprint"), F.col("edited_fingerprint"), F.col("next_fingerprint")
    return edit_with_next(docs, **more).withColumns({"a": likeness(f, e), "b": likeness(f, n)})


ROWS = [(7, None), (3, ""), (None, "no id."), (4, "One. Two! Three?\nFour"), (5, "é\U0001f600. " * 30), (9, "x" * 2000), (2, "\n\n..\n"), (11, "One. Two! Three?\nFour")]


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], ROWS[3:5]])
def test_rows(spark, rows):
    docs = spark.createDataFrame([(i, t, "c", "d") for i, t in rows], "doc_id long, text string, key string, copies string")
    assert result(compared(docs, bytes_a_range=64)) == brute(rows)


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "a. b."), (1, "a. b."), (1, "a. b."), (2, "c. d.")]
    got = compared(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.edited) for r in got) == [(1, "a. bc"), (1, "a. bc"), (1, "a. bc"), (2, "c. da")]
    assert compared(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_edits_are_located(spark):
    text = "".join(f"Line {k}.\n" for k in range(400))
    changed = text.replace("Line 200.", "Line two hundred.")
    docs = spark.createDataFrame([(1, text), (2, changed)], "doc_id long, text string")
    a, b = fingerprints(docs).orderBy("doc_id").collect()
    row = spark.createDataFrame([(a.fingerprint, b.fingerprint)], "a string, b string")
    got = row.select(edited_branches(F.col("a"), F.col("b")).alias("gone"), edited_branches(F.col("b"), F.col("a")).alias("new"), likeness(F.col("a"), F.col("b")).alias("like")).first()
    assert len(got.gone) in (1, 2) and got.like > 0.99
    assert leaves("Line 200.\n")[0] in ",".join(got.gone) and leaves("Line two hundred.\n")[0] in ",".join(got.new)


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r[1:7] for r in op8_merkle(spark, "/root/testdata/sf0.001").collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_every_document_follows_one_over_many_ranges(spark):
    n = 30_000
    docs = spark.range(n).selectExpr("id * 7919 % 30011 AS doc_id", "concat(id * 31 % 9973, ' text') AS text").repartition(3)
    keys = sorted(r.doc_id for r in docs.select("doc_id").collect())
    got = edit_with_next(docs, bytes_a_range=64 << 10).select("doc_id", "text", "edited").collect()
    text = {r.doc_id: r.text for r in got}
    assert len(got) == len(text) == n
    edited = {r.doc_id: r.edited for r in got}
    for k in range(n):
        t, q = text[keys[k]], len(text[keys[k]]) // 4
        assert edited[keys[k]] == t[: len(t) - q] + text[keys[(k + 1) % n]][:q]


def test_a_lost_document_stops_the_query(spark, monkeypatch):
    whole = merkle._in_order
    monkeypatch.setattr(merkle, "_in_order", lambda keys, size: whole(keys, size).where("NOT next_key LIKE '4:%'"))
    docs = spark.createDataFrame([(k, f"text {k}.") for k in range(9)], "doc_id long, text string")
    with pytest.raises(Exception, match="follows no document: 4:"):
        edit_with_next(docs).collect()
