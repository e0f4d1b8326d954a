"""Quality rules: fixed checks, then a calibrated logistic regression on hashed word and character n-grams.

Features are counts of hashed word 1- and 2-grams and of 3- and 4-grams of characters (code points),
each family as shares of a text. Platt scaling on rows that the fit didn't see makes the score a
probability at the labelled rows' own share of label 1; texts are scored in Arrow batches against the
fixed threshold.

Defined results: null text has no words and fails the base rules; without both labels in the
training rows only the base rules decide; repeated rows are judged alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from codalith.llm import common, labelled, textstats, words

U = np.uint64
#: Hash space of each n-gram family, the sample's bound (documents of each label), and the fixed thresholds.
FAMILY_BITS, PER_CLASS, KEEP = 13, 700, 0.5
MIN_WORDS, REPEAT_PERCENT, REPEAT_WIDTH = 20, 30, 8
FAMILIES = ("word", "word pair", "3 characters", "4 characters")


def _characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts and their n + 1 offsets; broken UTF-8 gives U+FFFD."""
    decode = lambda part: np.frombuffer(part.tobytes().decode(errors="replace").encode("utf-32-le"), np.uint32)
    codes = decode(data)
    leads = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    if len(codes) == leads[-1]:
        return codes, leads[offsets]
    parts = [decode(data[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    return np.concatenate([np.zeros(0, np.uint32), *parts]), np.r_[0, np.cumsum([len(x) for x in parts])].astype(np.int64)


def _slots(data: np.ndarray, offsets: np.ndarray, h: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each family: the hash slot of every n-gram, and where each document's n-grams begin."""
    shift = U(64 - FAMILY_BITS)
    for width in (1, 2):
        at, counts = words.window_starts(first, width)
        yield (words.mix(words.rolling(h, width, 0x9E3779B97F4A7C15)[at]) >> shift).astype(np.int32), np.r_[0, np.cumsum(counts)]
    codes, edges = _characters(data, offsets)
    codes = codes.astype(U) + U(1)
    for width in (3, 4):
        at, counts = words.window_starts(edges, width)
        gram = words.rolling(codes, width, 0x9E3779B97F4A7C15)
        gram *= U(0xBF58476D1CE4E5B9)  # the upper bits are those that all bits below have reached
        yield (gram >> shift).astype(np.int32)[at], np.r_[0, np.cumsum(counts)]


@dataclass
class NgramModel:
    weights: np.ndarray  # one row of 2 ** FAMILY_BITS for each family
    bias: float
    slope: float
    shift: float
    fitted: bool = True

    def linear(self, data: np.ndarray, offsets: np.ndarray, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        z = np.full(len(offsets) - 1, self.bias)
        for w, (slot, begin) in zip(self.weights, _slots(data, offsets, h, first)):
            z += np.diff(np.r_[0.0, np.cumsum(w[slot], dtype=np.float64)][begin]) / np.maximum(np.diff(begin), 1)
        return z

    def probability(self, z: np.ndarray) -> np.ndarray:
        return labelled.sigmoid(self.slope * z + self.shift) if self.fitted else np.ones(len(z))


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per labelled document its slots, family-wise offset, with their shares."""
    for batch in batches:
        data, offsets = common.utf8(batch.column("text"))
        slots, shares = [], []
        for k in range(len(batch)):
            part, local = data[offsets[k] : offsets[k + 1]], np.array([0, offsets[k + 1] - offsets[k]])
            starts, ends, first = words.bounds(part, local)
            own, share = [], []
            for f, (slot, _) in enumerate(_slots(part, local, words.hashes(part, starts, ends), first)):
                value, count = np.unique(slot, return_counts=True)
                own.append(value + (f << FAMILY_BITS))
                share.append(count / max(1, len(slot)))
            slots.append(np.concatenate(own).astype(np.uint16).tobytes())
            shares.append(np.concatenate(share).astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("label").cast(pa.int32()), pa.array(slots, pa.binary()), pa.array(shares, pa.binary())], ["doc_id", "label", "slots", "shares"])


def fit(slots: list[np.ndarray], shares: list[np.ndarray], y: np.ndarray, calibrates: np.ndarray, prior: float = 0.5, rounds: int = 60, l2: float = 1e-4) -> NgramModel:
    """Full-batch Adam on the logistic loss with classes weighted alike; Platt scaling on the rows that calibrate."""
    size = len(FAMILIES) << FAMILY_BITS
    empty = NgramModel(np.zeros((len(FAMILIES), 1 << FAMILY_BITS), np.float32), 0.0, 1.0, 0.0, False)
    own = np.flatnonzero(~calibrates)
    if not len(own) or len(set(y[own].tolist())) < 2:
        own, calibrates = np.arange(len(y)), np.ones(len(y), bool)
    if len(set(y.tolist())) < 2:
        return empty
    x = np.zeros((len(own), size), np.float32)  # as large for long texts as for short ones
    for k, r in enumerate(own.tolist()):
        x[k, slots[r]] = shares[r]
    scale = 1 / np.sqrt((x * x).mean(axis=0) + 1e-8)  # n-grams rare in a text weigh as much as frequent ones
    x *= scale
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True)) + 1e-9
    target = y[own].astype(np.float32)
    weight = np.where(target == 1, 0.5 / max(1, target.sum()), 0.5 / max(1, (1 - target).sum())).astype(np.float32)
    w, bias, m, v = np.zeros(size, np.float32), 0.0, np.zeros(size, np.float32), np.zeros(size, np.float32)
    for step in range(1, rounds + 1):
        residual = weight * (labelled.sigmoid(x @ w + bias) - target).astype(np.float32)
        gradient = residual @ x + l2 * w
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        bias -= 0.5 * float(residual.sum())
    full = w * scale
    # Scoring divides by a family's n-grams, not by a row's norm, so the bias goes to the calibration.
    check = np.flatnonzero(calibrates)
    slope, shift = labelled.platt(np.array([float(full[slots[r]] @ shares[r]) for r in check]), y[check], prior)
    return NgramModel(full.reshape(len(FAMILIES), -1).astype(np.float32), 0.0, slope, shift)


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> NgramModel:
    """Learns from at most per_class documents of each label outside the held-out fold; a document sends its distinct slots, 2 ** FAMILY_BITS a family at most."""
    rows = labelled.sample(docs, labels, "quality", per_class).mapInArrow(_sparse, "doc_id long, label int, slots binary, shares binary").toArrow().sort_by("doc_id")
    slots = [np.frombuffer(x, np.uint16) for x in rows["slots"].to_pylist()]
    shares = [np.frombuffer(x, np.float32) for x in rows["shares"].to_pylist()]
    prior = labelled.shares(labels, "quality").get(1, 0.5)
    return fit(slots, shares, rows["label"].to_numpy(), labelled.validation_fold(rows["doc_id"].to_numpy()), prior)


_COLUMNS = {"n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(), "n_repeat_words": pa.int64(), "base_failed": pa.bool_(), "kept": pa.bool_(), "probability": pa.float64()}


def _judge(model: NgramModel, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = common.utf8(batch.column("text"))
            out: dict[str, list] = {k: [] for k in _COLUMNS}
            for i, j in common.chunks(offsets):
                part, local = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                starts, ends, first = words.bounds(part, local)
                h = words.exact(part, starts, ends)
                n_words, repeats = np.diff(first), textstats.repeated_words(h, first, REPEAT_WIDTH)
                failed = (n_words < MIN_WORDS) | (100 * repeats > REPEAT_PERCENT * n_words)
                p = model.probability(model.linear(part, local, h, first))
                lines = [textstats.duplicate_lines(part[a:b].tobytes()) for a, b in zip(local[:-1].tolist(), local[1:].tolist())]
                for k, v in zip(_COLUMNS, (n_words, textstats.code_points(part, starts, ends, first), textstats.symbols(part, local), np.array(lines), repeats, failed, ~failed & (p >= threshold), p)):
                    out[k].append(v)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *(pa.array(np.concatenate(v), _COLUMNS[k]) if v else pa.array([], _COLUMNS[k]) for k, v in out.items())], ["doc_id", *_COLUMNS])

    return run


def judge(docs: DataFrame, model: NgramModel, threshold: float = KEEP) -> DataFrame:
    """Base counts, base_failed, kept and the calibrated probability of each document."""
    return docs.select("doc_id", "text").mapInArrow(_judge(model, threshold), "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, probability double")


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = common.read_documents(spark, sf_dir)
    return judge(docs, train(docs, common.table(spark, sf_dir, "labels")))
