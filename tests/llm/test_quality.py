"""The quality classifier: its parts against plain forms, its scores against held-out labels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm.quality import STATISTICS, describe, fit_and_score, isotonic, statistics


def test_isotonic_is_the_best_ascending_fit():
    rng = np.random.default_rng(0)
    values, means, counts = np.arange(40.0), rng.random(40) + np.arange(40) / 40, rng.integers(1, 9, 40)
    at, fitted = isotonic(values, means, counts)
    assert (np.diff(fitted) > 0).all() and (np.diff(at) > 0).all()
    # the fit by the largest of the smallest running means
    running = lambda i, j: np.average(means[i : j + 1], weights=counts[i : j + 1])
    want = [max(min(running(i, j) for j in range(k, 40)) for i in range(k + 1)) for k in range(40)]
    np.testing.assert_allclose(sorted(set(np.round(want, 12))), np.round(fitted, 12))


@pytest.mark.parametrize("text", ["", " \n", "a", "\n\nx", "é" * 50, "w " * 5000])
def test_statistics_are_finite(text):
    assert len(statistics(text)) == len(STATISTICS) and np.isfinite(statistics(text)).all()


def frames(spark, docs, labels):
    return (
        spark.createDataFrame(docs, "doc_id long, text string, x int, score string"),
        spark.createDataFrame(labels, "doc_id long, quality int, text string"),
    )


@pytest.mark.parametrize(
    "labels, want", [([], 0.5), ([(1, 1, "c")], 1.0), ([(1, 1, None), (2, 1, None)], 1.0), ([(None, 0, None), (1, None, None)], 0.5)]
)
def test_labels_that_teach_nothing(spark, labels, want):
    docs, marks = frames(spark, [(1, "good words", 1, "a"), (2, None, 1, "a"), (None, "", 1, "a"), (2, "again", 1, "a")], labels)
    got = fit_and_score(docs, marks, "quality", F.lit(True), F.lit(False)).collect()
    assert sorted((str(r.doc_id), r.score) for r in got) == sorted((k, want) for k in ("1", "2", "None", "2"))


def test_empty_table(spark):
    docs, marks = frames(spark, [], [(1, 1, "c")])
    assert fit_and_score(docs, marks, "quality", F.lit(True), F.lit(False)).collect() == []


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, marks = (spark.read.parquet(f"{folder}/{x}.parquet") for x in ("documents", "labels"))
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    got = fit_and_score(docs, marks, "quality", part.isin(2, 3, 4), part == 1).where(part == 0).join(marks, "doc_id").toPandas()
    good, bad = got[got.quality == 1].score, got[got.quality == 0].score
    assert len(good) and len(bad) and ((good.values[:, None] > bad.values).mean() + (good.values[:, None] == bad.values).mean() / 2) > 0.97
    assert describe(docs).count() == docs.count()
