"""Quality classifier: Bradley-Terry ranking of documents from preference pairs.

P(i preferred to j) = sigmoid(w . (x_i - x_j)); w minimises logistic loss on feature differences of
all pairs (label 1, label 0) of a bounded labelled sample, by Newton steps on the exact pair sums. The
threshold is a quantile of the sample's utilities, the one that divides the labels best, and maps to
score 0.3.

Inputs of a score are statistics of the text alone. Defined results: null text scores as empty text;
a training table without both labels gives every document 0.5; repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codalith.llm import common, labelled, textstats

#: Bound of the training sample: documents of each label.
PER_CLASS, L2 = 2000, 1.0
CUT = 0.3


@dataclass
class Ranker:
    """Linear utility of scaled features; score = sigmoid(slope * (utility - threshold)) moved so that the threshold scores CUT."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float
    threshold: float

    def utility(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not np.isfinite(self.threshold):
            return np.full(len(x), 0.5)
        return labelled.sigmoid(self.slope * (self.utility(x) - self.threshold) + np.log(CUT / (1 - CUT)))


def pair_weights(good: np.ndarray, bad: np.ndarray, l2: float = L2, rounds: int = 25) -> np.ndarray:
    """Weights that minimise the mean of log(1 + exp(-w . (g - b))) over all pairs, times 1000, and half of l2 |w|^2."""
    w = np.zeros(good.shape[1])
    scale = 1e3 / (len(good) * len(bad))
    for _ in range(rounds):
        p = labelled.sigmoid(np.subtract.outer(good @ w, bad @ w))  # P(good preferred), pair by pair
        q = p * (1 - p)
        gradient = scale * ((p - 1).sum(axis=1) @ good - (p - 1).sum(axis=0) @ bad) + l2 * w
        cross = good.T @ q @ bad
        hessian = scale * ((good * q.sum(axis=1)[:, None]).T @ good + (bad * q.sum(axis=0)[:, None]).T @ bad - cross - cross.T) + l2 * np.eye(len(w))
        step = np.linalg.solve(hessian + 1e-9 * np.eye(len(w)), gradient)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-7:
            break
    return w


def fit_pairs(x: np.ndarray, y: np.ndarray, l2: float = L2) -> Ranker:
    """Learns from all pairs of a row with y = 1 and one with y = 0."""
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-3) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Ranker(mean, scale, np.zeros(x.shape[1]), 1.0, -np.inf)
    z = np.clip((x - mean) / scale, -8, 8)
    weights = pair_weights(z[good], z[bad], l2)
    utility = z @ weights
    threshold = labelled.separating_threshold(utility, y)
    slope, _ = labelled.platt(utility, y)
    return Ranker(mean, scale, weights, slope, threshold)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = common.utf8(batch.column("text"))
        rows = [textstats.features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in common.chunks(offsets)]
        x = np.concatenate(rows) if rows else np.zeros((0, len(textstats.NAMES)))
        packed = pa.array([r.tobytes() for r in x], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("label").cast(pa.int32()), packed], ["doc_id", "label", "x"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Ranker:
    """Learns from at most per_class documents of each label outside the held-out fold."""
    rows = labelled.sample(docs, labels, "quality", per_class).mapInArrow(_features, "doc_id long, label int, x binary").toArrow().sort_by("doc_id")
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float64).reshape(-1, len(textstats.NAMES))
    return fit_pairs(x, rows["label"].to_numpy())


def column_scores(text: pa.Array, model: Ranker) -> np.ndarray:
    data, offsets = common.utf8(text)
    found = [model.score(textstats.features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])) for i, j in common.chunks(offsets)]
    return np.concatenate(found) if found else np.zeros(0)


def score(docs: DataFrame, model: Ranker) -> DataFrame:
    """doc_id and score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(column_scores(batch.column("text"), model))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Ranker, cut: float = CUT) -> DataFrame:
    """The rows of docs that score cut or more, all columns."""
    return common.filter_batches(docs, lambda: lambda text: column_scores(text, model) >= cut)


def op5_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = common.read_documents(spark, sf_dir)
    scored = score(docs, train(docs, common.table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(labelled.held_out(), F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted"))
