"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

Merges are taken from an agenda, highest score first and then leftmost. A candidate merge is skipped
for good if a keyed hash of the seed, the document, the unit's place in it and the candidate's place
in the unit falls below the dropout rate; so each occurrence of a unit is drawn for itself, and the
same inputs always give the same segmentation, on any executor. A candidate is its three borders: a
later merge of the same symbols with a grown neighbour is another candidate. At rate 0 the ids are the
library's own.

Pieces don't cross from a character to a space behind it, so a text is cut before each run of spaces.
Kept for every distinct unit are its merges and ids without dropout, which don't depend on a draw; an
occurrence that drops none of these merges has these ids, and all others are merged anew. Short units
merge side by side in arrays, one merge of each per round; long ones use a heap.

Defined results: null and empty texts have no ids. U+2581 in a text stands for a space, as in the
library, and decodes as one, so such a text isn't lossless; all other texts decode to themselves. Repeated rows of one doc_id are
segmented alike if their texts are; a null doc_id counts as 0.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codalith.llm import common, words

U = np.uint64
MARK = "▁"
SEED, RATE = 20, 0.1
STEP_BYTES, LONG_UNIT = 1 << 20, 48
LONG_MARK = 1 << 40


class PairTable:
    """Numbers by pairs of symbols, in a hash table of arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = U(64 - max(4, (4 * len(keys)).bit_length()))
        self.keys, self.values = np.full(1 << (64 - int(self.shift)), -1, np.int64), np.full(1 << (64 - int(self.shift)), -1, np.int64)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = np.flatnonzero(self.keys[slot] == -1)
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.values[slot[put]] = keys[left[put]], values[left[put]]
            rest = np.ones(len(left), bool)
            rest[put] = False
            left, slot = left[rest], (slot[rest] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(U) * U(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where there is none."""
        slot = self._slot(keys)
        known = self.keys[slot]
        out = np.where(known == keys, self.values[slot], -1)
        at = np.flatnonzero((known != keys) & (known != -1))
        slot = slot[at]
        while len(at):
            slot = (slot + 1) & (len(self.keys) - 1)
            known = self.keys[slot]
            hit = known == keys[at]
            out[at[hit]] = self.values[slot[hit]]
            on = ~hit & (known != -1)
            at, slot = at[on], slot[on]
        return out


class MergeCoder:
    def __init__(self, path: str, rate: float = RATE, seed: int = SEED):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
        pieces = [model.id_to_piece(i) for i in range(n)]
        number = {p: i for i, p in enumerate(pieces) if not special(i)}
        if any(MARK in p.lstrip(MARK) for p in number):
            raise ValueError("a piece crosses from a character to a space behind it")
        self.byte_ids = np.full(256, model.unk_id(), np.int64)
        for i in range(n):
            if model.is_byte(i):
                self.byte_ids[int(pieces[i][3:5], 16)] = i
        self.n = n
        for c in sorted({c for p in number for c in p}):
            number.setdefault(c, len(pieces) + len(number))
        self.number = number
        pairs = []
        for p, i in number.items():
            if i < n:
                pairs += [(number[p[:k]] << 32 | number[p[k:]], i) for k in range(1, len(p)) if p[:k] in number and p[k:] in number]
        self.pairs = PairTable(np.array([k for k, _ in pairs], np.int64), np.array([i for _, i in pairs], np.int64))
        self.score = np.array([model.get_score(i) for i in range(n)], np.float64)
        self.pair_dict = dict(pairs)
        single = sorted((ord(p), i) for p, i in number.items() if len(p) == 1)
        self.code_points, self.code_symbols = np.array([c for c, _ in single], np.uint32), np.array([i for _, i in single], np.int64)
        self.limit = U(min(int(rate * 2**64), 2**64 - 1))
        self.rate, self.seed = rate, seed
        shown = [bytes([int(pieces[i][3:5], 16)]) if model.is_byte(i) else b"" if model.is_control(i) else pieces[i].replace(MARK, " ").encode() for i in range(n)]
        self.shown_length = np.array([len(x) for x in shown], np.int64)
        self.shown_start = np.cumsum(self.shown_length) - self.shown_length
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.pool = words.SlicePool(U)  # of each unit: how many merges it has, their places, its ids

    def _skipped(self, key: np.ndarray, left: np.ndarray, middle: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the candidate with these borders is dropped, in a unit of this key."""
        return words.mix(key ^ self._place(left, middle, right)) < self.limit

    @staticmethod
    def _place(left: np.ndarray, middle: np.ndarray, right: np.ndarray) -> np.ndarray:
        return words.mix(left.astype(U) * U(0x9E3779B97F4A7C15) + middle.astype(U) * U(0xC2B2AE3D27D4EB4F) + right.astype(U) * U(0x165667B19E3779F9))

    def _long(self, text: str, key: int) -> list[int]:
        """Symbols of one unit by a heap."""
        symbols = [self.number.get(c, -1) for c in text]
        n = len(symbols)
        begin, end = list(range(n)), list(range(1, n + 1))
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, int, int, int]] = []
        own = np.array([key], U)

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else n
            if i < 0 or j >= n:
                return
            piece = self.pair_dict.get(symbols[i] << 32 | symbols[j]) if symbols[i] >= 0 and symbols[j] >= 0 else None
            if piece is not None and not (self.rate and self._skipped(own, np.array([begin[i]]), np.array([begin[j]]), np.array([end[j]]))[0]):
                heapq.heappush(heap, (-self.score[piece], begin[i], begin[j], end[j], piece))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, left, middle, right, piece = heapq.heappop(heap)  # symbols are named by their first character
            if symbols[left] is None or symbols[middle] is None or end[left] != middle or end[middle] != right:
                continue
            symbols[left], symbols[middle] = piece, None
            end[left], after[left] = right, after[middle]
            if after[left] < n:
                before[after[left]] = left
            offer(before[left])
            offer(left)
        return [x for i, s in enumerate(symbols) if s is not None for x in self._ids(s, text[begin[i] : end[i]])]

    def _ids(self, symbol: int, text: str) -> list[int]:
        return [symbol] if 0 <= symbol < self.n else self.byte_ids[list(text.encode())].tolist()

    def _short(self, units: list[str], keys: np.ndarray | None, merges: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units in their order, and how many each has; without keys nothing is dropped, and merges gets (unit, place) arrays."""
        size = np.array([len(u) for u in units], np.int64)
        codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        found = np.minimum(np.searchsorted(self.code_points, codes), len(self.code_points) - 1)
        symbol = np.where(self.code_points[found] == codes, self.code_symbols[found], -1)
        unit = np.repeat(np.arange(len(units)), size)
        char = np.arange(len(codes))
        origin = (np.cumsum(size) - size)[unit]
        stop = (char + 1).copy()
        done: list[tuple[np.ndarray, np.ndarray]] = []  # first character and symbol of what is final

        def look(at: np.ndarray) -> np.ndarray:
            """The piece that the symbols at and at + 1 make; -1 where there is none or the candidate is dropped."""
            left, right = symbol[at], symbol[at + 1]
            found = self.pairs.find(left << 32 | right)
            good = (found >= 0) & (unit[at] == unit[at + 1]) & (left >= 0) & (right >= 0)
            if keys is not None and self.rate:
                k = at[good]
                good[good] = ~self._skipped(keys[unit[k]], char[k] - origin[k], char[k + 1] - origin[k], stop[k + 1] - origin[k])
            return np.where(good, found, -1)

        piece = np.r_[look(np.arange(max(0, len(symbol) - 1))), np.full(min(1, len(symbol)), -1)]
        while len(symbol):
            at = np.flatnonzero(piece >= 0)
            if not len(at):
                done.append((char, symbol))
                break
            value, owner = self.score[piece[at]], unit[at]
            begin = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            top = np.repeat(np.maximum.reduceat(value, begin), np.diff(np.r_[begin, len(at)]))
            best = np.flatnonzero(value == top)
            best = best[np.r_[True, owner[best][1:] != owner[best][:-1]]]  # the leftmost of each unit
            left = at[best]
            if merges is not None:
                merges.append((unit[left], self._place(char[left] - origin[left], char[left + 1] - origin[left], stop[left + 1] - origin[left])))
            symbol[left], stop[left] = piece[left], stop[left + 1]
            keep = np.ones(len(symbol), bool)
            keep[left + 1] = False
            live = np.zeros(len(units), bool)
            live[owner] = True
            live = live[unit]
            over = keep & ~live
            if over.any():
                done.append((char[over], symbol[over]))
                keep &= live
            merged = (np.cumsum(keep) - 1)[left]
            symbol, unit, char, origin, stop, piece = symbol[keep], unit[keep], char[keep], origin[keep], stop[keep], piece[keep]
            piece[merged] = -1
            changed = np.r_[merged[merged < len(symbol) - 1], merged[merged > 0] - 1]  # a merged symbol has new neighbours on either side
            piece[changed] = look(changed)
        char = np.concatenate([c for c, _ in done])
        symbol = np.concatenate([s for _, s in done])
        order = np.argsort(char)
        char, symbol = char[order], symbol[order]
        owner = np.repeat(np.arange(len(units)), size)[char]
        odd = np.flatnonzero((symbol < 0) | (symbol >= self.n))
        if len(odd):  # a character without a piece becomes its bytes
            spans = [self._ids(-1, chr(codes[char[k]])) for k in odd.tolist()]
            times = np.ones(len(symbol), np.int64)
            times[odd] = [len(x) for x in spans]
            place = np.cumsum(times) - times
            out, owner = np.repeat(symbol, times), np.repeat(owner, times)
            for k, x in zip(place[odd].tolist(), spans):
                out[k : k + len(x)] = x
            symbol = out
        return symbol.astype("<u4"), np.bincount(owner, minlength=len(units))

    def _encode(self, units: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        length = np.array([len(u) for u in units], np.int64)
        short, long = np.flatnonzero(length <= LONG_UNIT), np.flatnonzero(length > LONG_UNIT)
        lengths, parts = np.zeros(len(units), np.int64), [np.zeros(0, "<u4")]
        if len(short):
            ids, lengths[short] = self._short([units[k] for k in short.tolist()], keys[short])
            parts.append(ids)
        for k in long.tolist():
            ids = self._long(units[k], int(keys[k]))
            lengths[k] = len(ids)
            parts.append(np.array(ids, "<u4"))
        order = np.r_[short, long]
        begin = np.empty(len(units), np.int64)
        begin[order] = np.cumsum(lengths[order]) - lengths[order]
        return words.gather(np.concatenate(parts), begin, lengths), lengths

    def _undropped(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """What the pool keeps of each unit; of a long one that it has a merge which is always dropped."""
        size = np.array([len(u) for u in units], np.int64)
        short, merges = np.flatnonzero(size <= LONG_UNIT), []
        n_merges, n_ids = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        ids = owner = place = np.zeros(0, U)
        if len(short):
            ids, n_ids[short] = self._short([units[k] for k in short.tolist()], None, merges)
        if merges:
            owner, place = (np.concatenate(x) for x in zip(*merges))
            order = np.argsort(owner, kind="stable")
            place, n_merges[short] = place[order], np.bincount(owner, minlength=len(short))
        length = 1 + n_merges + n_ids
        begin = np.cumsum(length) - length
        out = np.zeros(int(length.sum()), U)
        out[begin] = np.where(size <= LONG_UNIT, n_merges, LONG_MARK)
        for first, count, values in ((begin + 1, n_merges, place), (begin + 1 + n_merges, n_ids, ids)):
            out[np.repeat(first - (np.cumsum(count) - count), count) + np.arange(len(values))] = values
        return out, length

    def encode(self, batch: list[str], doc_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids, their edges per text, and the bytes that they must decode to with edges per text."""
        prepared = [(" " + t.replace(MARK, " ")).encode() if t else b"" for t in batch]
        data = np.frombuffer(b"".join(prepared), np.uint8)
        offsets = np.r_[0, np.cumsum([len(x) for x in prepared])].astype(np.int64)
        space = data == 0x20
        head = space.copy()
        head[1:] &= ~space[:-1]
        head[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(head)
        ends = np.r_[starts[1:], len(data)] if len(starts) else starts
        n_units = np.diff(np.searchsorted(starts, offsets))
        document = words.mix(doc_ids.astype(np.int64).view(U) ^ words.mix(np.array([self.seed], np.int64).view(U)))
        nth = np.arange(len(starts)) - np.repeat(np.cumsum(n_units) - n_units, n_units)
        keys = words.mix(np.repeat(document, n_units) + nth.astype(U) * U(0x9E3779B97F4A7C15))
        raw = data.tobytes()
        texts = lambda at: [raw[a:b].decode().replace(" ", MARK) for a, b in zip(starts[at].tolist(), ends[at].tolist())]
        begin, length = self.pool.look_up(data, starts, ends, lambda new: self._undropped(texts(new)))
        n_merges = self.pool.pool[begin].astype(np.int64)
        again = n_merges == LONG_MARK
        n_merges[again] = 0
        if self.rate:
            drawn = np.repeat(np.arange(len(starts)), n_merges)
            again[drawn[words.mix(keys[drawn] ^ words.gather(self.pool.pool, begin + 1, n_merges)) < self.limit]] = True
        n_ids = np.where(again, 0, length - 1 - n_merges)
        kept = words.gather(self.pool.pool, begin + 1 + n_merges, n_ids).astype("<u4")
        place = np.cumsum(n_ids) - n_ids
        redo = np.flatnonzero(again)
        if len(redo):
            new, n_ids[redo] = self._encode(texts(redo), keys[redo])
            place[redo] = len(kept) + np.cumsum(n_ids[redo]) - n_ids[redo]
            kept = np.concatenate([kept, new])
        edges = np.r_[0, np.cumsum(n_ids)][np.r_[0, np.cumsum(n_units)]]
        return words.gather(kept, place, n_ids), edges, data, offsets

    def decoded(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that ids stand for, a space before the first word included."""
        return words.gather(self.shown, self.shown_start[ids], self.shown_length[ids])

    def decode(self, ids) -> str:
        """The text of ids: the space before the first word goes, broken UTF-8 becomes U+FFFD."""
        text = self.decoded(np.asarray(ids, np.int64)).tobytes()
        return (text[1:] if text[:1] == b" " else text).decode(errors="replace")


def _coder(path: str, rate: float, seed: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = MergeCoder(path, rate, seed)
        for batch in batches:
            _, offsets = common.utf8(batch.column("text"))
            doc_ids = batch.column("doc_id").cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
            for i, j in common.chunks(offsets, STEP_BYTES):
                own = [x or "" for x in batch.column("text").slice(i, j - i).to_pylist()]
                ids, edges, _, _ = coder.encode(own, doc_ids[i:j])
                shown = coder.decoded(ids)
                at = np.r_[0, np.cumsum(coder.shown_length[ids])][edges]
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
                same = [shown[a:b].tobytes() == (" " + t if t else "").encode() for a, b, t in zip(at[:-1].tolist(), at[1:].tolist(), own)]
                columns = [batch.column("doc_id").slice(i, j - i).cast(pa.int64()), pa.array(np.diff(edges)), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())]
                names = ["doc_id", "n_ids", "ids_crc32", "lossless"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def encode(docs: DataFrame, model_path: str, rate: float = RATE, seed: int = SEED, with_ids: bool = True) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (of little-endian unsigned 32-bit ids), lossless (the ids decode to the text itself), and ids."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(_coder(model_path, rate, seed, with_ids), "doc_id long, n_ids long, ids_crc32 long, lossless boolean" + ", ids array<int>" * with_ids)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text of doc_id and ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = MergeCoder(model_path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([coder.decode(x or []) for x in batch.column("ids").to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op9_merge_dropout(spark, sf_dir: str) -> DataFrame:
    return encode(common.read_documents(spark, sf_dir), default_model(), with_ids=False)
