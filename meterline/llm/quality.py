"""A quality classifier: kernel ridge regression on random Fourier features, calibrated isotonically.

Each text becomes a few statistics. Cosines of random projections of them
approximate a Gaussian kernel; every partition sums its part of the normal
equations, so the solved system has a fixed size whatever the number of rows.
A pool-adjacent-violators fit on rows that the ridge did not see turns raw
values into probabilities.

Defined results: a null or empty text is scored like any other, from zero
statistics; a row without an id is scored but never learned from; several
labels of one document count as their mean; rows with equal ids are scored one
by one; without usable labels, or with one class only, every score is the mean
label (0.5 if there is none). Columns other than the two named are left behind.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import stored, texts

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "symbols", "not_ascii", "spaces",
    "entropy", "distinct_words", "distinct_pairs", "top_word", "log_lines", "distinct_lines",
    "line_bytes", "sentence_ends", "longest_word", "marked_words",
)
FEATURES = 256
RIDGE = 1e-3
#: Raw values are counted in so many bins of this width from this value on, for the calibration.
BINS, BIN_WIDTH, FIRST_BIN = 1500, 0.002, -1.0

_UPPER, _DIGIT = slice(65, 91), slice(48, 58)
_SYMBOLS = [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,"]


def statistics(text: str) -> list[float]:
    raw = text.encode("utf-8", "replace")
    n = len(raw)
    words = text.split()
    if not words:
        return [math.log1p(n)] + [0.0] * (len(STATISTICS) - 1)
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    shares = counts[counts > 0] / n
    lines = [x for x in text.split("\n") if x]
    tally = Counter(words)
    w = len(words)
    marked = sum(k for word, k in tally.items() if not word[-1].isalnum() and word[-1] not in ".,")
    return [
        math.log1p(n), math.log1p(w), n / w, counts[_UPPER].sum() / n, counts[_DIGIT].sum() / n,
        counts[_SYMBOLS].sum() / n, counts[128:].sum() / n, counts[32] / n,
        float(-(shares * np.log2(shares)).sum()), len(tally) / w, len(set(zip(words, words[1:]))) / max(1, w - 1),
        max(tally.values()) / w, math.log1p(len(lines)), len(set(lines)) / len(lines),
        math.log1p(n / len(lines)), counts[46] / w, math.log1p(max(map(len, tally))), marked / w,
    ]


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash`` and ``x``, the statistics of the whole text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array([statistics(t.as_py()) for t in batch.column("text")], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), x], ["doc_id", "text_hash", "x"])

    source = texts(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, text_hash bigint, x array<double>")


@dataclass(frozen=True)
class QualityModel:
    """All that scoring needs: the scale of the statistics, the projection, the weights, the calibration."""

    mean: np.ndarray
    scale: np.ndarray
    projection: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    raw_at: np.ndarray
    score_at: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        waves = np.sqrt(2 / len(self.phase)) * np.cos(z @ self.projection + self.phase)
        return np.hstack([waves, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.raw_at, self.score_at), 0.0, 1.0)


def isotonic(values: np.ndarray, means: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over ascending ``values``: the centres and means of the pools."""
    pools: list[list[float]] = []
    for v, m, n in zip(values, means, counts):
        pools.append([v * n, m * n, n])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _normal_equations(rows: DataFrame, model: QualityModel) -> tuple[np.ndarray, np.ndarray]:
    """The sums of the outer products and of the products with the label, row by row of the matrix."""
    size = len(model.phase) + 1

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            z = model.features(_rows(batch))
            y = batch.column("y").to_numpy(zero_copy_only=False)
            total += z.T @ np.column_stack([z, y])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(list(total), pa.list_(pa.float64()))], ["k", "v"])

    def together(table: pa.Table) -> pa.Table:
        v = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        return pa.table({"k": table.column("k")[:1], "v": pa.array([v.sum(axis=0)], pa.list_(pa.float64()))})

    parts = rows.select("x", "y").mapInArrow(summed, "k bigint, v array<double>")
    got = parts.groupBy("k").applyInArrow(together, "k bigint, v array<double>").collect()  # one row per feature
    full = np.array([r.v for r in sorted(got, key=lambda r: r.k)])
    return full[:, :-1], full[:, -1]


def train(described: DataFrame, labels: DataFrame, label: str, learn: Column, calibrate: Column, seed: int = 7) -> QualityModel:
    """Fit on all labelled rows where ``learn`` holds, calibrate on those where ``calibrate`` does (conditions on ``doc_id``)."""
    marks = labels.select(labels["doc_id"].alias("doc_id"), labels[label].cast("double").alias("y"))
    marks = marks.where("doc_id IS NOT NULL AND y IS NOT NULL").groupBy("doc_id").agg(F.avg("y").alias("y"))
    rows = described.join(marks.where(learn | calibrate), "doc_id")
    n_stats = len(STATISTICS)
    one = [x for k in range(n_stats) for x in (F.avg(F.col("x")[k]).alias(f"m{k}"), F.stddev_pop(F.col("x")[k]).alias(f"s{k}"))]
    fitted = F.count_if(learn).alias("n")
    moments = rows.agg(fitted, F.avg("y").alias("y"), F.stddev_pop("y").alias("spread"), *one).first()
    rng = np.random.default_rng(seed)
    blank = dict(
        mean=np.array([moments[f"m{k}"] or 0.0 for k in range(n_stats)]),
        scale=np.array([moments[f"s{k}"] or 1.0 for k in range(n_stats)]),
        projection=rng.normal(size=(n_stats, FEATURES)) / np.sqrt(n_stats),
        phase=rng.uniform(0, 2 * np.pi, FEATURES),
    )
    if not moments["n"] or not moments["spread"]:
        mean = 0.5 if moments["y"] is None else moments["y"]
        return QualityModel(**blank, weights=np.zeros(FEATURES + 1), raw_at=np.zeros(1), score_at=np.array([mean]))
    plain = QualityModel(**blank, weights=np.zeros(FEATURES + 1), raw_at=np.zeros(1), score_at=np.zeros(1))
    outer, target = _normal_equations(rows.where(learn), plain)
    weights = np.linalg.solve(outer + RIDGE * moments["n"] * np.diag([1.0] * FEATURES + [0.0]) / FEATURES, target)
    ridge = QualityModel(**blank, weights=weights, raw_at=np.zeros(1), score_at=np.zeros(1))

    def raw(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(ridge.raw(_rows(batch))), batch.column("y")], ["raw", "y"])

    values = rows.where(calibrate).select("x", "y").mapInArrow(raw, "raw double, y double")
    place = F.floor((F.col("raw") - FIRST_BIN) / BIN_WIDTH)
    bins = values.groupBy(F.greatest(F.lit(0), F.least(F.lit(BINS - 1), place)).alias("bin")).agg(
        F.avg("raw").alias("at"), F.avg("y").alias("y"), F.count("*").alias("n")
    )
    found = sorted(bins.collect())  # at most BINS rows
    if not found:
        return QualityModel(**blank, weights=weights, raw_at=np.array([0.0, 1.0]), score_at=np.array([0.0, 1.0]))
    at, mean = isotonic(*(np.array([r[k] for r in found], dtype=float) for k in ("at", "y", "n")))
    return QualityModel(**blank, weights=weights, raw_at=at, score_at=mean)


def score(described: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``score``, the probability of label 1."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = pa.array(model.score(_rows(batch)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), scores], ["doc_id", "text_hash", "score"])

    return described.mapInArrow(run, f"doc_id {described.schema['doc_id'].dataType.simpleString()}, text_hash bigint, score double")


def fit_and_score(docs: DataFrame, labels: DataFrame, label: str, learn: Column, calibrate: Column) -> DataFrame:
    """Statistics of all texts once, a model of the labelled ones, and a score for each row."""
    described = stored(describe(docs), "statistics")
    return score(described, train(described, labels, label, learn, calibrate))
