"""Words of UTF-8 texts as arrays: bounds, 64-bit hashes, rolling windows. A word is [^\\x20\\x09-\\x0D]+.

Word hashes take eight bytes at a time through a bijective mixer, so words of up to eight bytes never
collide with others of their length; longer words may, and whoever needs exactness compares bytes
with `same`, as `exact` and `SlicePool` do.
"""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Words of more bytes are hashed and compared one by one, not in lanes of eight bytes.
LANE_BYTES = 64
#: Most entries, and bytes of their words, that a SlicePool holds before it starts anew.
CACHE_ENTRIES, CACHE_BYTES = 1_000_000, 64 << 20
_GOLDEN = 0x9E3779B97F4A7C15
_LOW = np.array([0] + [(1 << 8 * k) - 1 for k in range(1, 9)], U)


def _splitmix(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U) * U(_GOLDEN) + U(seed))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def bounds(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each document the number of its first word (n + 1 numbers); apart says which bytes are in no word."""
    filled = ~apart[data]
    edge = np.ones(len(data) + 1, bool)
    if len(data):
        edge[1:-1] = filled[1:] != filled[:-1]
        edge[offsets] = True
    starts = np.flatnonzero(filled & edge[:-1])
    ends = np.flatnonzero(filled & edge[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _lanes(data: np.ndarray) -> np.ndarray:
    """For every place in data the eight bytes from there on, as a number; zeros follow the data."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data) + 1, np.dtype("<u8"), padded, 0, (1,))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0, step: int = 1 << 16) -> np.ndarray:
    """A 64-bit hash of each word's bytes and length."""
    out = np.empty(len(starts), U)
    begin = mix(np.array([seed & (2**64 - 1)], U) ^ U(_GOLDEN))[0]
    for k in range(0, len(starts), step):
        s, e = starts[k : k + step], ends[k : k + step]
        length = e - s
        h = mix(length.astype(U) * U(_GOLDEN) ^ begin)
        long = length > LANE_BYTES
        at = np.flatnonzero(~long)
        if len(at):
            low, high = int(s[0]), int(e[-1])
            lanes = _lanes(data[low:high]) if high - low <= 64 * len(s) + (1 << 20) else None
            place = 0
            while len(at):
                left = length[at] - place
                if lanes is None:  # few short words between very long ones: no copy of those
                    lane = np.array([int.from_bytes(data[a : min(a + 8, b)].tobytes(), "little") for a, b in zip((s[at] + place).tolist(), e[at].tolist())], U)
                else:
                    lane = lanes[s[at] + (place - low)] & _LOW[np.minimum(left, 8)]
                h[at] = mix(h[at] ^ lane)
                place += 8
                at = at[left > 8]
        for n in np.flatnonzero(long).tolist():
            h[n] = xxhash.xxh3_64_intdigest(data[s[n] : e[n]], int(begin))
        out[k : k + step] = h
    return out


def same(a: np.ndarray, a_start: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_start: np.ndarray, b_end: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    """Which slices of a equal the slices of b that stand beside them, byte by byte."""
    length = a_end - a_start
    ok = length == b_end - b_start
    lanes_a = _lanes(a)
    lanes_b = lanes_a if b is a else _lanes(b)
    for k in range(0, len(ok), step):
        at = np.flatnonzero(ok[k : k + step] & (length[k : k + step] <= LANE_BYTES) & (length[k : k + step] > 0)) + k
        place = 0
        while len(at):
            left = length[at] - place
            differs = ((lanes_a[a_start[at] + place] ^ lanes_b[b_start[at] + place]) & _LOW[np.minimum(left, 8)]) != 0
            ok[at[differs]] = False
            place += 8
            at = at[~differs & (left > 8)]
    for n in np.flatnonzero(ok & (length > LANE_BYTES)).tolist():
        ok[n] = np.array_equal(a[a_start[n] : a_end[n]], b[b_start[n] : b_end[n]])
    return ok


def exact(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Word hashes that are equal for equal words alone, within this data."""
    return exact_by_seeds(data, starts, ends)[0]


def exact_by_seeds(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, int]:
    """The hashes of exact(), and with how many seeds, from 0 on, they were made."""
    keys = hashes(data, starts, ends)
    odd, seed = np.arange(len(keys)), 0
    while True:
        _, first, which = np.unique(keys, return_index=True, return_inverse=True)
        twin = first[which]
        odd = np.flatnonzero((twin != np.arange(len(keys))) & ~same(data, starts, ends, data, starts[twin], ends[twin]))
        if not len(odd):
            return keys, seed + 1
        seed += 1
        keys[odd] = hashes(data, starts[odd], ends[odd], seed)


def rolling(h: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rabin-Karp hash of every run of width values (documents not yet kept apart)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, U)
    out = h[:n].copy()
    for j in range(1, width):
        out *= U(base)
        out += h[j : j + n]
    return out


def window_starts(first_word: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers at which a window lies in one document, and the number of windows of each document."""
    n_words = np.diff(first_word)
    n_windows = np.maximum(n_words - width + 1, 0)
    total = int(n_windows.sum())
    shift = np.repeat(first_word[:-1] - (np.cumsum(n_windows) - n_windows), n_windows)
    return np.arange(total) + shift, n_windows


def covered(hit_starts: np.ndarray, width: int, n_words: int) -> np.ndarray:
    """Which words lie in a window that starts at one of hit_starts."""
    step = np.zeros(n_words + 1, np.int64)
    np.add.at(step, hit_starts, 1)
    np.add.at(step, hit_starts + width, -1)
    return np.cumsum(step[:-1]) > 0


def gather(pool: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The slices pool[start : start + length] one after another."""
    shift = start - (np.cumsum(length) - length)
    return pool[np.arange(int(length.sum())) + np.repeat(shift, length)]


class _Column:
    """An array that grows at its end."""

    def __init__(self, dtype):
        self.full, self.n = np.zeros(1024, dtype), 0

    def add(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.full):
            grown = np.zeros(max(self.n + len(values), 3 * len(self.full) // 2), self.full.dtype)
            grown[: self.n] = self.full[: self.n]
            self.full = grown
        self.full[self.n : self.n + len(values)] = values
        self.n += len(values)

    @property
    def values(self) -> np.ndarray:
        return self.full[: self.n]


class SlicePool:
    """A bounded store of value slices by word, for what many texts ask again and again.

    Words are found by their hash and compared by their bytes; a word whose hash another one has is
    looked up by a hash of another seed.
    """

    def __init__(self, dtype, limit: int = CACHE_ENTRIES, byte_limit: int = CACHE_BYTES):
        self.limit, self.byte_limit, self.dtype = limit, byte_limit, dtype
        self.clear()

    def clear(self) -> None:
        self.known, self.entry = np.zeros(0, U), np.zeros(0, np.int64)  # sorted keys, and the entry of each
        self.recent, self.recent_entry = self.known, self.entry  # the same of what came last; joined to known now and then
        self.start, self.length, self.word_start, self.word_end = (_Column(np.int64) for _ in range(4))
        self._pool, self.bytes = _Column(self.dtype), _Column(np.uint8)

    @property
    def pool(self) -> np.ndarray:
        return self._pool.values

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The entry of each key, or -1."""
        out = np.full(len(keys), -1, np.int64)
        for known, entry in ((self.known, self.entry), (self.recent, self.recent_entry)):
            if len(known):
                place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = known[place] == keys
                out[hit] = entry[place[hit]]
        return out

    def _add(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        entries = self.start.n + np.arange(len(keys))
        self.start.add(self._pool.n + np.cumsum(lengths) - lengths)
        self.length.add(lengths)
        self._pool.add(values)
        size = ends - starts
        self.word_start.add(self.bytes.n + np.cumsum(size) - size)
        self.word_end.add(self.bytes.n + np.cumsum(size))
        self.bytes.add(gather(data, starts, size))
        merged, entry = np.r_[self.recent, keys], np.r_[self.recent_entry, entries]
        if 8 * len(merged) > len(self.known):
            merged, entry = np.r_[self.known, merged], np.r_[self.entry, entry]
            order = np.argsort(merged, kind="stable")
            self.known, self.entry = merged[order], entry[order]
            self.recent, self.recent_entry = merged[:0], entry[:0]
        else:
            order = np.argsort(merged, kind="stable")
            self.recent, self.recent_entry = merged[order], entry[order]
        return entries

    def look_up(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, make) -> tuple[np.ndarray, np.ndarray]:
        """Start and length in self.pool of each word's values; make(numbers of words) gives values and lengths of those that are new."""
        if self.start.n >= self.limit or self.bytes.n >= self.byte_limit:
            self.clear()
        found = np.full(len(starts), -1, np.int64)
        rest, seed = np.arange(len(starts)), 0
        while len(rest):
            keys = hashes(data, starts[rest], ends[rest], seed)
            distinct, first, which = np.unique(keys, return_index=True, return_inverse=True)
            leader = rest[first]
            entry = self._find(distinct)
            old = np.flatnonzero(entry >= 0)
            right = np.ones(len(distinct), bool)
            if len(old):
                right[old] = same(data, starts[leader[old]], ends[leader[old]], self.bytes.values, self.word_start.values[entry[old]], self.word_end.values[entry[old]])
            new = np.flatnonzero(entry < 0)
            if len(new):
                values, lengths = make(leader[new])
                entry[new] = self._add(distinct[new], data, starts[leader[new]], ends[leader[new]], values, lengths)
            twin = leader[which]
            fits = right[which] & ((twin == rest) | same(data, starts[rest], ends[rest], data, starts[twin], ends[twin]))
            found[rest[fits]] = entry[which[fits]]
            rest, seed = rest[~fits], seed + 1
        return self.start.values[found], self.length.values[found]
