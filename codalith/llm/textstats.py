"""Dense statistics of whole texts, computed for many documents at once."""

from __future__ import annotations

from collections import Counter

import numpy as np

from codalith.llm import words

U = np.uint64
_CLASSES = ("lower", "upper", "digit", "space", "newline", ".", ",", "!", "?", "|", "#", "*", "$", "%", "&", "<", ">", "quote", "dash", "other", "wide", "rest")
_CLASS_OF = np.full(256, _CLASSES.index("other"), np.uint8)
for _name, _bytes in {
    "lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "space": (32, 9, 11, 12, 13), "newline": (10,), "quote": b"\"'`", "dash": b"-_", "wide": range(192, 256), "rest": range(128, 192),
    **{c: c.encode() for c in _CLASSES if len(c) == 1},
}.items():
    _CLASS_OF[list(_bytes)] = _CLASSES.index(_name)
NAMES = [f"share of {c}" for c in _CLASSES] + ["word length", "distinct words", "word repeats the last", "words in repeated pairs", "words in repeated windows", "words with no letter or digit", "words ending oddly", "words all upper", "line length", "repeated lines", "empty"]
SYMBOL = np.zeros(256, np.int64)
SYMBOL[list(b"#*$%&|<>")] = 1
_CONTINUES = (np.arange(256) & 0xC0) == 0x80
_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_ENDS = _PLAIN.copy()
_ENDS[list(b".,;:?!)\"'")] = True


def _sum_by(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values between neighbouring entries of first."""
    total = np.r_[0, np.cumsum(values)]
    return total[first[1:]] - total[first[:-1]]


def repeated_words(h: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    """Per document the words in windows of width words found twice or more in it, first included; h tells words apart."""
    at, n_windows = words.window_starts(first, width)
    if not len(at):
        return np.zeros(len(first) - 1, np.int64)
    doc = np.repeat(np.arange(len(n_windows), dtype=U), n_windows)
    key = words.mix(words.rolling(h, width, 0xD6E8FEB86659FD93)[at]) ^ words.mix(doc + U(1))
    order = np.argsort(key)
    ordered = key[order]
    same = ordered[1:] == ordered[:-1]
    hit = np.zeros(len(key), bool)
    one, other = order[:-1][same], order[1:][same]
    if not all(np.array_equal(h[at[one] + j], h[at[other] + j]) for j in range(width)) or not np.array_equal(doc[one], doc[other]):
        windows = [(d, *h[a : a + width].tolist()) for d, a in zip(doc.tolist(), at.tolist())]  # different windows of equal keys
        seen = Counter(windows)
        hit[:] = [seen[w] > 1 for w in windows]
    else:
        hit[one] = hit[other] = True
    return _sum_by(words.covered(at[hit], width, len(h)), first)


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def code_points(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Code points inside words, per document."""
    leads = np.r_[0, np.cumsum(~_CONTINUES[data])]
    return _sum_by(leads[ends] - leads[starts], first)


def symbols(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return _sum_by(SYMBOL[data], offsets)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of NAMES for each document."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    doc = np.repeat(np.arange(n), size)
    k = len(_CLASSES)
    counts = np.bincount(doc * k + _CLASS_OF[data], minlength=n * k).reshape(n, k)
    starts, ends, first = words.bounds(data, offsets)
    h = words.hashes(data, starts, ends)
    n_words = np.maximum(np.diff(first), 1)
    word_doc = np.repeat(np.arange(n, dtype=U), np.diff(first))
    key = np.sort(h ^ words.mix(word_doc + U(1)))
    distinct_key = words.mix(word_doc + U(1))
    order = np.argsort(h ^ distinct_key)
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    distinct = np.bincount(word_doc[order][new].astype(np.int64), minlength=n)
    again = np.zeros(len(h), bool)
    again[1:] = h[1:] == h[:-1]
    again[first[:-1][first[:-1] < len(h)]] = False
    plain = np.r_[0, np.cumsum(_PLAIN[data])]
    upper = np.r_[0, np.cumsum(_UPPER[data])]
    length = ends - starts
    raw = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    lines = counts[:, _CLASSES.index("newline")] + 1
    repeats = np.array([duplicate_lines(data[a:b].tobytes()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], np.float64)
    columns = [
        *(counts / np.maximum(size, 1)[:, None]).T,
        _sum_by(length, first) / n_words / 10,
        distinct / np.sqrt(n_words) / 10,
        _sum_by(again, first) / n_words,
        repeated_words(h, first, 2) / n_words,
        repeated_words(h, first, 5) / n_words,
        _sum_by(plain[ends] == plain[starts], first) / n_words,
        _sum_by(~_ENDS[raw], first) / n_words,
        _sum_by((upper[ends] - upper[starts] >= 2) & (upper[ends] - upper[starts] == plain[ends] - plain[starts]), first) / n_words,
        np.log1p(size / lines) / 10,
        repeats / np.maximum(lines, 1),
        (np.diff(first) == 0).astype(float),
    ]
    return np.stack(columns, axis=1)
