"""Toxicity: cumulative-link ordinal regression on sparse text features.

P(grade > k) = sigmoid(w . x - theta_k): one weight vector for all thresholds, theta kept in order by
positive steps. x holds log(1 + count) of lower-cased letter runs and of their beginnings (so that
inflected forms count), as far as the labelled sample shows them often enough and unevenly enough.
Expected severity is the sum of P(grade > k) over the thresholds.

The table `labels` knows two grades, so one threshold is learnt there; any number works.

Defined results: null text counts as empty; a sample of one grade gives that grade to all; repeated
rows score alike; features are compared whole, so hash collisions can't make a clean text toxic.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codalith.llm import common, labelled, words

#: Bounds of the training sample (documents of each label) and of the features learnt from it.
PER_CLASS, MAX_FEATURES, MIN_DOCUMENTS, MIN_CHI2 = 2000, 4000, 4, 12.0
#: Lengths of the beginnings of a letter run that are features.
BEGINNINGS = range(3, 7)
TOXIC = 0.5
_RUN = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    """Features of one white-space-separated word: its letter runs, and ^ with their beginnings."""
    return [f for run in _RUN.findall(word.lower()) for f in (run, *("^" + run[:n] for n in BEGINNINGS if n <= len(run)))]


@dataclass
class OrdinalModel:
    weights: dict[str, float] = field(default_factory=dict)
    thresholds: tuple[float, ...] = ()
    lowest: int = 0

    def expected(self, z: np.ndarray) -> np.ndarray:
        return self.lowest + sum((labelled.sigmoid(z - t) for t in self.thresholds), np.zeros(len(z)))

    def severity(self, text: str | None) -> float:
        """Expected grade of one text."""
        counts = Counter(f for w in (text or "").split() for f in word_features(w) if f in self.weights)
        return float(self.expected(np.array([sum(self.weights[f] * np.log1p(n) for f, n in counts.items())]))[0])


class Scorer:
    """Expected grades of many texts; each distinct word is taken apart once."""

    def __init__(self, model: OrdinalModel):
        self.model = model
        self.number = {f: i for i, f in enumerate(model.weights)}
        self.weights = np.array(list(model.weights.values()) or [0.0])
        self.pool = words.SlicePool(np.int32)

    def column(self, text: pa.Array) -> np.ndarray:
        data, offsets = common.utf8(text)
        z = np.zeros(len(offsets) - 1)
        for i, j in common.chunks(offsets):
            part, local = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            starts, ends, first = words.bounds(part, local)
            raw = part.tobytes()

            def make(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                found = [[self.number[f] for f in word_features(raw[a:b].decode(errors="replace")) if f in self.number] for a, b in zip(starts[new].tolist(), ends[new].tolist())]  # noqa: B023
                return np.array([x for f in found for x in f], np.int32), np.array([len(f) for f in found], np.int64)

            begin, length = self.pool.look_up(part, starts, ends, make)
            doc = np.repeat(np.repeat(np.arange(j - i), np.diff(first)), length)
            seen, count = np.unique(doc * len(self.weights) + words.gather(self.pool.pool, begin, length), return_counts=True)
            z[i:j] = np.bincount(seen // len(self.weights), weights=self.weights[seen % len(self.weights)] * np.log1p(count), minlength=j - i)
        return self.model.expected(z)


def fit(features: list[dict[int, float]], grades: np.ndarray, n_features: int, l2: float = 1e-3, rounds: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds; Adam on the cumulative-link likelihood, grades weighted alike. Grades are 0 ... K - 1."""
    k = int(grades.max()) if len(grades) else 0
    if k < 1:
        return np.zeros(n_features), np.zeros(0)
    row = np.repeat(np.arange(len(features)), [len(f) for f in features])
    index = np.fromiter((i for f in features for i in f), np.int64, len(row))
    value = np.fromiter((v for f in features for v in f.values()), np.float64, len(row))
    count = np.bincount(grades, minlength=k + 1)
    weight = 1 / (np.maximum(count, 1)[grades] * (count > 0).sum())
    above = grades[:, None] > np.arange(k)[None, :]
    p = np.zeros(n_features + k)  # weights, first threshold, logs of the steps
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, rounds + 1):
        w, steps = p[:n_features], np.exp(np.clip(p[n_features + 1 :], -8, 8))
        theta = p[n_features] + np.r_[0, np.cumsum(steps)]
        z = np.bincount(row, weights=w[index] * value, minlength=len(features))
        s = labelled.sigmoid(z[:, None] - theta[None, :])  # P(grade > k)
        upper = np.c_[np.ones(len(s)), s][np.arange(len(s)), grades]
        lower = np.c_[s, np.zeros(len(s))][np.arange(len(s)), grades]
        mass = np.maximum(upper - lower, 1e-12)
        # d log(mass) / d (z - theta_j): the upper edge is column grade - 1, the lower one column grade.
        slope = s * (1 - s)
        part = np.zeros_like(s)
        has_upper, has_lower = grades > 0, grades < k
        part[has_upper, grades[has_upper] - 1] += slope[has_upper, grades[has_upper] - 1] / mass[has_upper]
        part[has_lower, grades[has_lower]] -= slope[has_lower, grades[has_lower]] / mass[has_lower]
        part *= -weight[:, None]
        gradient = np.zeros_like(p)
        gradient[:n_features] = np.bincount(index, weights=part.sum(axis=1)[row] * value, minlength=n_features) + l2 * w / len(features)
        to_theta = -part.sum(axis=0)
        gradient[n_features] = to_theta.sum()
        gradient[n_features + 1 :] = steps * np.cumsum(to_theta[::-1])[::-1][1:]
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        p -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    theta = p[n_features] + np.r_[0, np.cumsum(np.exp(np.clip(p[n_features + 1 :], -8, 8)))]
    return p[:n_features], theta


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [Counter(f for w in (x or "").split() for f in word_features(w)) for x in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("label").cast(pa.int32()), pa.array([list(c) for c in found], pa.list_(pa.string())), pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))], ["doc_id", "label", "features", "counts"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_features: int = MAX_FEATURES, min_documents: int = MIN_DOCUMENTS) -> OrdinalModel:
    """Learns from at most per_class documents of each label outside the held-out fold.

    Features are kept that min_documents sample documents hold and whose document shares differ between
    the grades (chi-square of MIN_CHI2 or more), at most max_features of them, the most uneven first.
    """
    rows = common.stage_table(labelled.sample(docs, labels, "toxic", per_class, all_grades=True).mapInArrow(_counts, "doc_id long, label int, features array<string>, counts array<int>"), "toxic")
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return OrdinalModel(lowest=next(iter(totals), 0))
    all_rows = sum(totals.values())
    held = [F.count(F.when(F.col("label") == g, 1)).alias(f"k{i}") for i, g in enumerate(sorted(totals))]
    seen = rows.select("label", F.explode("features").alias("f")).groupBy("f").agg(F.count("*").alias("n"), *held).where(F.col("n") >= min_documents)
    share = F.col("n") / all_rows
    uneven = sum((F.pow(F.col(f"k{i}") / totals[g] - share, 2) * totals[g] for i, g in enumerate(sorted(totals))), F.lit(0.0))
    chi2 = uneven / F.greatest(share * (1 - share), F.lit(1e-9))
    chosen = [r["f"] for r in seen.where(chi2 >= MIN_CHI2).orderBy(chi2.desc(), "f").limit(max_features).collect()]
    lowest = min(totals)
    if not chosen:
        return OrdinalModel(lowest=lowest)
    number = {f: i for i, f in enumerate(chosen)}
    pick = F.broadcast(docs.sparkSession.createDataFrame(list(number.items()), "f string, i int"))  # max_features rows at most
    long = rows.select("doc_id", F.explode(F.arrays_zip("features", "counts")).alias("w")).select("doc_id", F.col("w.features").alias("f"), F.col("w.counts").alias("n")).join(pick, "f")
    # What comes to the driver is bounded by the sample's documents times max_features.
    packed = rows.select("doc_id", "label").join(long.groupBy("doc_id").agg(F.collect_list("i").alias("i"), F.collect_list("n").alias("n")), "doc_id", "left").toArrow().sort_by("doc_id")
    features = [dict(zip(i or [], np.log1p(n or []).tolist())) for i, n in zip(packed["i"].to_pylist(), packed["n"].to_pylist())]
    weights, theta = fit(features, packed["label"].to_numpy() - lowest, len(number))
    return OrdinalModel({f: float(weights[i]) for f, i in number.items() if abs(weights[i]) > 1e-4}, tuple(theta.tolist()), lowest)


def score(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """doc_id and severity, the expected grade."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scorer.column(batch.column("text")))], ["doc_id", "severity"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, severity double")


def keep_mild(docs: DataFrame, model: OrdinalModel, toxic: float = TOXIC) -> DataFrame:
    """The rows of docs below the severity toxic, all columns."""
    return common.filter_batches(docs, lambda: lambda text, scorer=Scorer(model): scorer.column(text) < toxic)


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = common.read_documents(spark, sf_dir)
    scored = score(docs, train(docs, common.table(spark, sf_dir, "labels")))
    return scored.select("doc_id", "severity", F.round("severity").cast("int").alias("grade"), (F.col("severity") >= TOXIC).alias("toxic"))
