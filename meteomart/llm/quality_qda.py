"""Quality classifier: regularised quadratic discriminant over document statistics.

``features`` turns each whole text into a vector of transformed statistics.
``fit`` takes at most ``per_class`` labelled documents of each class (a
documented bound), estimates class means and covariances, shrinks each
covariance towards the pooled one and towards its own diagonal, and keeps the
Cholesky factors.  The discriminant is the difference of the Mahalanobis
log-densities; a one-dimensional logistic fit on the same sample turns it into
a score from 0 to 1.

Defined results.  Null or empty text: the vector of an empty text, scored like
any other.  Null id or label: never learned from; a row with a null id is
scored, with ``held_out`` false.  Ties and repeated rows: each row is scored on its
own, equal texts alike.  Fewer than ``MIN_CLASS`` sample rows of a class, so
also empty tables: every score is the (smoothed) share of label 1.  Columns
other than those named are ignored, or kept unchanged by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteomart.llm import text as X
from meteomart.llm.tables import bounded_sample, fold

PER_CLASS = 3000
THRESHOLD = 0.7
TO_POOLED = 0.2
TO_DIAGONAL = 0.1
MIN_CLASS = 5

# Byte classes: 0 other, 1 lower, 2 upper, 3 digit, 4 space or tab, 5 line end,
# 6 sentence mark, 7 exclamation or question mark, 8 bar, 9 beyond ASCII.
_KIND = np.zeros(256, np.uint8)
_KIND[ord("a"):ord("z") + 1] = 1
_KIND[ord("A"):ord("Z") + 1] = 2
_KIND[ord("0"):ord("9") + 1] = 3
_KIND[[9, 32]] = 4
_KIND[[10, 11, 12, 13]] = 5
_KIND[[ord(c) for c in ".,;:"]] = 6
_KIND[[ord(c) for c in "!?"]] = 7
_KIND[ord("|")] = 8
_KIND[128:] = 9
_LINE = np.zeros(256, bool)
_LINE[10] = True
FEATURES = ("log words", "mean word", "sd word", "upper", "digit", "symbol", "sentence", "exclaim",
            "bar", "beyond", "distinct words", "distinct lines", "distinct triples", "log line words")


def chunk_features(chunk: X.Chunk) -> np.ndarray:
    """One row of FEATURES for each document of the chunk."""
    size = np.diff(chunk.offsets)
    kinds = X.kind_counts(chunk, _KIND, 10).astype(float)
    starts, ends, off = X.runs(chunk, X.WHITE)
    words = X.run_hashes(chunk, starts, ends)
    length = ends - starts
    del starts, ends
    count = np.diff(off)
    some = np.maximum(count, 1)
    mean = X.per_document(length, off) / some
    length *= length
    sd = np.sqrt(np.maximum(X.per_document(length, off) / some - mean * mean, 0))
    del length
    share = lambda hashes, o: X.distinct_per_document(hashes, o) / np.maximum(np.diff(o), 1)
    distinct_words, distinct_triples = share(words, off), share(*X.shingles(words, off, 3))
    del words
    starts, ends, l_off = X.runs(chunk, _LINE)
    distinct_lines = share(X.run_hashes(chunk, starts, ends), l_off)
    n_lines = np.maximum(np.diff(l_off), 1)
    letters = np.maximum(kinds[:, 1] + kinds[:, 2], 1)
    marks = np.maximum(size, 1)
    return np.column_stack([
        np.log1p(count), np.log1p(mean), np.log1p(sd), np.sqrt(kinds[:, 2] / letters),
        np.sqrt(kinds[:, 3] / marks), np.sqrt(kinds[:, 0] / some), np.sqrt(kinds[:, 6] / some),
        np.sqrt(kinds[:, 7] / some), np.sqrt(kinds[:, 8] / some), np.sqrt(kinds[:, 9] / marks),
        distinct_words, distinct_lines, distinct_triples, np.log1p(count / n_lines)])


def batch_features(texts: pa.Array) -> np.ndarray:
    parts = [chunk_features(c) for c in X.chunks(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    means: list
    factors: list          # inverse Cholesky factors of the two shrunk covariances
    log_dets: list
    slope: float
    offset: float

    def discriminant(self, x: np.ndarray) -> np.ndarray:
        """log density of class 1 less that of class 0, per feature."""
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        out = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets, strict=True):
            y = np.einsum("ij,kj->ik", z - mean, factor)
            out.append(-0.5 * (y * y).sum(axis=1) - 0.5 * log_det)
        return (out[1] - out[0]) / x.shape[1]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.factors:
            return np.full(len(x), 1 / (1 + np.exp(-self.offset)))
        return 1 / (1 + np.exp(-np.clip(self.slope * self.discriminant(x) + self.offset, -40, 40)))


def fit_arrays(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Model:
    """weight: how many labelled documents each sample row stands for."""
    groups = [x[y == c] for c in (0, 1)]
    share = (weight[y == 1].sum() + 0.5) / (weight.sum() + 1)
    if min(map(len, groups)) < MIN_CLASS:
        return Model(np.zeros(1), np.ones(1), [], [], [], 0.0, float(np.log(share / (1 - share))))
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = [np.clip((g - centre) / scale, -8, 8) for g in groups]
    means = [g.mean(axis=0) for g in z]
    own = [np.cov(g.T) for g in z]
    pooled = (own[0] + own[1]) / 2
    factors, dets = [], []
    for s in own:
        s = (1 - TO_POOLED) * s + TO_POOLED * pooled
        s = (1 - TO_DIAGONAL) * s + TO_DIAGONAL * np.diag(np.diag(s)) + 1e-3 * np.eye(len(s))
        factor = np.linalg.cholesky(s)
        factors.append(np.linalg.inv(factor))
        dets.append(2 * float(np.log(np.diag(factor)).sum()))
    model = Model(centre, scale, means, factors, dets, 1.0, 0.0)
    model.slope, model.offset = _logistic(model.discriminant(x), y, weight)
    return model


def _logistic(d: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (at least 0) and offset by Newton steps with a small ridge."""
    a = np.column_stack([d, np.ones_like(d)])
    b = np.array([1.0, 0.0])
    w = weight / weight.sum() * len(weight)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a[:, 0] * b[0] + b[1], -30, 30)))
        g = np.einsum("ij,i->j", a, w * (y - p)) - 1e-2 * b
        h = np.einsum("ij,i,ik->jk", a, w * p * (1 - p), a) + 1e-2 * np.eye(2)
        step = np.linalg.solve(h, g)
        b = b + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(b[0]), 0.0), float(b[1])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Learn from labelled documents whose crc32 fold of 4 is not 2."""
    known = (labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
             .where(fold(F.col("doc_id"), 4) != 2)
             .groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality")))
    counts = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    # At most 2 * per_class rows of two numbers: a proven bound for the broadcast.
    picked = F.broadcast(bounded_sample(known, "quality", F.col("doc_id"), per_class))
    sample = (docs.select("doc_id", "text").join(picked, "doc_id")
              .select("quality", "text").mapInArrow(_sample_features, "quality int, x array<double>")
              .collect())
    x = np.array([r["x"] for r in sample]).reshape(len(sample), len(FEATURES))
    y = np.array([r["quality"] for r in sample], int)
    have = np.bincount(y, minlength=2)
    return fit_arrays(x, y, np.array([counts[c] / have[c] for c in y]))


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = batch_features(b.column(1))
        off = np.arange(len(x) + 1) * len(FEATURES)
        yield pa.RecordBatch.from_arrays([b.column(0), X.lists(x.ravel(), off, pa.float64())], ["quality", "x"])


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score(batch_features(b.column(2)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])
    rows = docs.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that the model accepts."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(model.score(batch_features(b.column(at))) >= threshold))
    return docs.mapInArrow(run, docs.schema)
