"""Best-fit packing: tokenised documents into as few fixed-size sequences as possible, by best-two-fit.

Only lengths decide, so the plan is made on the histogram of lengths (at most `capacity` entries,
whatever the corpus holds) and says how often each pattern of lengths is used. A pattern is filled
greedily, always with the longest document that fits; then its smallest document is replaced by two
unpacked documents that fill the widened gap more tightly, if there are such two. A smallest document
of more than a third of the capacity stays, since two in its place are missing in other sequences. A
pattern repeats as long as the histogram can pay for it, so the plan's size doesn't grow with the
corpus either.

Pieces get their places by a number within their length: a count per (length, bucket of pieces) gives
each bucket its offset, so no length is numbered in one task. Buckets go by a number that each piece
gets when it is written, so equal rows are dealt out like others.

Defined results: null text is an empty document, which is the end id alone; repeated doc_id rows are
packed each; a null doc_id is packed too; other columns are ignored.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codalith.llm import common, words

CAPACITY, END_ID = 2048, 0
#: Bytes of text in a tokenizing step, pieces in a numbering bucket.
STEP_BYTES, BUCKET_PIECES = 2 << 20, 50_000

_MARKS = ".,!?;:"


def _folded(text: str) -> str | None:
    """Normal form C, then lower case by single code points, as the tokenizer has it; None where a second pass would differ."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()  # str.lower looks at a sigma's neighbours
    return text if unicodedata.is_normalized("NFC", text) else None


class WordTokenizer:
    """Ids of a tokenizer whose tokens don't cross white space.

    Each distinct white-space-separated chunk of a step is looked up once in a bounded pool; what is
    missing goes through the tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.pool = words.SlicePool("<u4")

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks in their order, and how many each has.

        Words, and words with one mark behind them, go through joined by spaces and are told apart by
        their end-of-word ids, one for the word and one for the mark.
        """
        parts = np.array([1 if c.isalpha() else 2 if c[-1] in _MARKS and c[:-1].isalpha() else 0 for c in chunks], np.int64)
        plain, lengths, found = np.flatnonzero(parts), np.zeros(len(chunks), np.int64), [np.zeros(0, "<u4")]
        if len(plain):
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join([chunks[k] for k in plain.tolist()])], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(self.ends_word[ids]) + 1
            if len(stops) != parts.sum():
                raise RuntimeError("a word has no end-of-word id")
            lengths[plain] = np.diff(np.r_[0, stops[np.cumsum(parts[plain]) - 1]])
            found.append(ids)
        other = np.flatnonzero(parts == 0)
        if len(other):
            rest = [e.ids for e in self.tokenizer.encode_batch_fast([chunks[k] for k in other.tolist()], add_special_tokens=False)]
            lengths[other] = [len(x) for x in rest]
            found.append(np.fromiter(chain.from_iterable(rest), "<u4", int(lengths[other].sum())))
        order = np.r_[plain, other]
        begin = np.empty(len(chunks), np.int64)
        begin[order] = np.cumsum(lengths[order]) - lengths[order]
        return words.gather(np.concatenate(found), begin, lengths), lengths

    def ids(self, batch: list[str]) -> list[np.ndarray]:
        """Unsigned 32-bit ids of each text."""
        folded = [None if any(s in text for s in self.specials) else _folded(text) for text in batch]
        encoded = [(x or "").encode() for x in folded]
        data, offsets = np.frombuffer(b"".join(encoded), np.uint8), np.r_[0, np.cumsum([len(x) for x in encoded])].astype(np.int64)
        starts, ends, first = words.bounds(data, offsets)
        raw = data.tobytes()
        begin, length = self.pool.look_up(data, starts, ends, lambda new: self._encode([raw[a:b].decode() for a, b in zip(starts[new].tolist(), ends[new].tolist())]))
        flat = words.gather(self.pool.pool, begin, length)
        edges = np.r_[0, np.cumsum(length)][first]
        return [self.whole(text) if low is None else flat[a:b] for text, low, a, b in zip(batch, folded, edges[:-1].tolist(), edges[1:].tolist())]


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def _pieces(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            _, offsets = common.utf8(batch.column("text"))
            doc_ids = batch.column("doc_id").to_pylist()
            text = batch.column("text")
            for i, j in common.chunks(offsets, STEP_BYTES):
                rows: list[list] = [[], [], [], [], []]
                for d, ids in zip(doc_ids[i:j], tokenizer.ids([x or "" for x in text.slice(i, j - i).to_pylist()])):
                    ids = ids.tobytes() + end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        for column, value in zip(rows, (d, k, at // 4, len(part) // 4, zlib.crc32(part))):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, _PIECES)], schema=_PIECES)
        del tokenizer
        common.trim()  # else each waiting worker keeps a tokenizer and what it has looked up

    return run


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's ids with end_id behind them."""
    common.small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_pieces(tokenizer_path, capacity, end_id), "doc_id long, piece int, start long, length long, ids_crc32 long")


def _at_most(counts: np.ndarray, limit: int) -> int:
    """The largest length up to limit that is left, or 0."""
    if limit < 1:
        return 0
    left = np.flatnonzero(counts[1 : limit + 1])
    return int(left[-1]) + 1 if len(left) else 0


def _two_for(counts: np.ndarray, gap: int, better_than: int) -> tuple[int, int] | None:
    """Two lengths left whose sum is at most gap, as large as can be, and larger than better_than."""
    lengths = np.flatnonzero(counts[: gap + 1])
    lengths = lengths[lengths > 0]
    if not len(lengths):
        return None
    partner = np.searchsorted(lengths, gap - lengths, side="right") - 1
    ok = partner >= 0
    a, b = lengths[ok], lengths[np.maximum(partner, 0)][ok]
    single = (a == b) & (counts[a] < 2)
    b = np.where(single, np.r_[0, lengths][np.maximum(partner[ok], 0)], b)  # the next shorter one instead
    total = np.where(b > 0, a + b, 0)
    best = int(np.argmax(total)) if len(total) else -1
    return (int(a[best]), int(b[best])) if best >= 0 and total[best] > better_than else None


def plan_patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, number of such sequences), for counts of each length."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    plan: list[tuple[tuple[int, ...], int]] = []
    while True:
        first = _at_most(counts, capacity)
        if not first:
            return plan
        used = [first]
        counts[first] -= 1
        gap = capacity - first
        while gap and (nxt := _at_most(counts, gap)):
            used.append(nxt)
            counts[nxt] -= 1
            gap -= nxt
        smallest = used[-1]
        if gap and len(used) > 1 and 3 * smallest <= capacity:
            pair = _two_for(counts, gap + smallest, smallest)
            if pair:
                used[-1:] = pair
                counts[smallest] += 1
                for x in pair:
                    counts[x] -= 1
        need = {x: used.count(x) for x in used}
        more = min(int(counts[x]) // k for x, k in need.items())
        for x, k in need.items():
            counts[x] -= more * k
        plan.append((tuple(sorted(used, reverse=True)), 1 + more))


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank + 1, first sequence, offset) for every slot of every pattern."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, n in plan:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            rows.append((length, rank, rank + n, sequence, offset))
            used[length] = rank + n
            offset += length
        sequence += n
    return rows


def _placer(slots: list[tuple[int, int, int, int, int]]):
    by_length: dict[int, np.ndarray] = {}
    for length in {s[0] for s in slots}:
        by_length[length] = np.array([s[1:] for s in slots if s[0] == length], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(zero_copy_only=False), batch.column("rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for value in np.unique(length).tolist():
                at, own = np.flatnonzero(length == value), by_length[value]
                slot = own[np.searchsorted(own[:, 0], rank[at], side="right") - 1]
                sequence[at] = slot[:, 2] + rank[at] - slot[:, 0]
                offset[at] = slot[:, 3]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in _PIECES.names), pa.array(sequence), pa.array(offset)], [*_PIECES.names, "sequence_id", "offset"])

    return run


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """parts (from pieces) with sequence_id and offset."""
    parts = common.stage_table(parts.withColumn("place", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    n_buckets = max(16, sum(histogram.values()) // BUCKET_PIECES)
    dealt = parts.withColumn("bucket", F.pmod(F.xxhash64("place"), F.lit(n_buckets)).cast("int"))
    counted = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    # Rows of counted: a length's buckets, n_buckets at most; they are summed within the length.
    before = counted.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).select("length", "bucket", "before")
    local = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("place"))
    ranked = dealt.join(before, ["length", "bucket"]).withColumn("rank", F.col("before") + local - 1)
    return ranked.select(*_PIECES.names, "rank").mapInArrow(_placer(_slots(plan_patterns(histogram, capacity))), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(pieces(common.read_documents(spark, sf_dir), default_tokenizer()))
