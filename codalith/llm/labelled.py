"""Labelled rows for training: the fold that may be learnt from, and a bounded sample of its documents."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codalith.llm import common

#: crc32(doc_id as text) mod FOLDS is 0 for held-out rows, which no model sees.
FOLDS = 5


def held_out(doc_id="doc_id"):
    return (F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS) == 0


def validation_fold(doc_ids: np.ndarray, folds: int = 5) -> np.ndarray:
    """Of training rows, those that calibrate: another hash than that of held_out."""
    return np.array([zlib.crc32(b"calibration %d" % d) % folds == 0 for d in doc_ids.tolist()], bool)


def sample(docs: DataFrame, labels: DataFrame, column: str, per_class: int, all_grades: bool = False) -> DataFrame:
    """(doc_id, text, label) of at most per_class rows for each of labels 0 and 1, or for each that occurs, the first by a hash of doc_id.

    The rows are chosen before the join, so what is broadcast holds per_class pairs a label at most.
    A doc_id with several labels counts as its largest, one with several texts as the smallest of them;
    null and held-out rows are left out.
    """
    common.small_batches(docs.sparkSession)
    usable = labels.where(f"doc_id IS NOT NULL AND {column} IS NOT NULL").where(~held_out()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(column).cast("int").alias("label"))
    chosen = None
    grades = sorted(r["label"] for r in usable.select("label").distinct().collect()) if all_grades else []
    for value in grades or (0, 1):
        part = usable.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))


def shares(labels: DataFrame, column: str) -> dict[int, float]:
    """How many usable rows each label has, of all that may be learnt from: a row per label comes to the driver."""
    usable = labels.where(f"doc_id IS NOT NULL AND {column} IS NOT NULL").where(~held_out())
    rows = usable.groupBy(F.col(column).cast("int").alias("label")).count().collect()
    return {r["label"]: r["count"] / sum(x["count"] for x in rows) for r in rows}


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def newton_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float, rounds: int = 25) -> np.ndarray:
    """Weights of a logistic regression on few dense columns, by Newton steps; an intercept is a column of ones."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) + l2 * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + l2 * np.eye(len(w))
        step = np.linalg.solve(hessian + 1e-9 * np.eye(len(w)), gradient)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-7:
            break
    return w


def platt(z: np.ndarray, y: np.ndarray, prior: float = 0.5) -> tuple[float, float]:
    """Slope and shift of P(1) = sigmoid(slope * z + shift) where a share prior of all rows has label 1; smoothed so that few rows can't overstate."""
    if not len(z) or y.min() == y.max():
        return 1.0, 0.0
    weight = np.where(y == 1, prior / max(1, (y == 1).sum()), (1 - prior) / max(1, (y == 0).sum())) * len(y)
    target = np.where(y == 1, 1 - 1 / (2 + (y == 1).sum()), 1 / (2 + (y == 0).sum()))
    scale = max(1e-9, float(np.std(z)))
    slope, shift = newton_logistic(np.c_[z / scale, np.ones(len(z))], target, weight, 1e-3)
    return max(slope, 1e-6) / scale, shift


def separating_threshold(score: np.ndarray, y: np.ndarray) -> float:
    """The quantile of score that divides labels 0 and 1 best by balanced accuracy: the middle of the best gap."""
    if not len(score) or y.min() == y.max():
        return -np.inf
    order = np.argsort(score, kind="stable")
    s, t = score[order], y[order]
    zeros_below = np.r_[0, np.cumsum(t == 0)] / (t == 0).sum()
    ones_above = 1 - np.r_[0, np.cumsum(t == 1)] / (t == 1).sum()
    gain = zeros_below + ones_above
    gain[1:-1][s[1:] == s[:-1]] = -1
    middles = np.r_[s[0] - 1, (s[1:] + s[:-1]) / 2, s[-1] + 1]
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float(middles[best[len(best) // 2]])
