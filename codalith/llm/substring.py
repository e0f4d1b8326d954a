"""Substring deduplication: every window of `width` words that also starts in an earlier document goes.

Rabin-Karp hashes of all windows are taken per block of documents and reduced to one record per
distinct window and block, the block's smallest doc_id. Records travel packed, a row per block and
bucket of hashes. A bucket is read as a stream: it keeps one record per distinct window and passes on
what a smaller doc_id takes from the others. Losses are gathered by document and joined to it. Windows
that repeat merge into maximal removal intervals.

A window that a third of all documents hold costs one record per block, and its bucket no memory for
them; rows that repeat a doc_id cost one record for each window and sixteen bits of the text's hash. There are never more rows than windows: buckets grow in number with the corpus, not in size, and
the rows between blocks and them shrink to single records.

Windows are equal if 64 bits of one word hash, 8 bits of another and the bits that choose the bucket
are: in 10 ** 12 windows, some 6 TB in a million buckets, a ten-thousandth of a wrong equality is
expected. Words of up to eight bytes have no equal hashes.

Defined results: null text has no words; a text of fewer than `width` words loses nothing; rows that
share a doc_id count as one document (none removes the other's windows) and each gets its own row;
a row of null doc_id is returned, loses nothing and removes nothing; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codalith.llm import common, words

U = np.uint64
WIDTH = 13
BASE, SECOND_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
#: Windows in a block, which are reduced together before the shuffle; text bytes for each bucket of hashes and each part of the documents.
BLOCK_WINDOWS, BUCKET_BYTES, PART_BYTES = 1 << 20, 6 << 20, 6 << 20
#: Packed rows that go to the JVM at once.
ROWS_AT_ONCE = 32

#: Columns that deal out documents with the same doc_id and bring back what a document loses.
ROUTE, HITS = "__codalith_route", "__codalith_hits"

_PACKED = pa.schema([("bucket", pa.int64()), ("records", pa.binary())])
_LOSSES = pa.schema([("doc_id", pa.int64()), ("route", pa.int32()), ("hits", pa.binary())])
#: Window hashes, bits of their second hashes, doc_ids and routes, side by side.
Records = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _route():
    """Sixteen bits of a text, so that rows of one doc_id don't all get each other's answers."""
    return F.coalesce(F.xxhash64("text").bitwiseAND(F.lit(0xFFFF).cast("long")), F.lit(0).cast("long")).cast("int")


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values begin in sorted keys, and their lengths."""
    begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return begin, np.diff(np.r_[begin, len(keys)])


def _pick(records: Records, at) -> Records:
    return tuple(x[at] for x in records)


def _joined(pieces: list[Records]) -> Records:
    return tuple(np.concatenate(x) for x in zip(*pieces))


def _distinct(window: np.ndarray, docs: np.ndarray, route: np.ndarray) -> np.ndarray:
    """Places of one record of each window, doc_id and route. Records that share a hash but are different stay, whatever else is there."""
    key = words.mix(window.astype(U) * U(BASE) ^ words.mix(docs.view(U) ^ words.mix(route.astype(U) + U(1))))
    order = np.argsort(key)
    again = np.zeros(len(order), bool)
    again[1:] = (key[order[1:]] == key[order[:-1]]) & (window[order[1:]] == window[order[:-1]]) & (docs[order[1:]] == docs[order[:-1]]) & (route[order[1:]] == route[order[:-1]])
    return np.sort(order[~again])


def first_owners(records: Records) -> tuple[np.ndarray, np.ndarray]:
    """The places of one record per window, of its smallest doc_id (and for each of that one's routes), and of one record for each window, doc_id and route of larger doc_ids."""
    h, second, docs, route = records
    order = np.argsort(h)
    begin, size = _runs(h[order])
    run = np.repeat(np.arange(len(begin)), size)
    odd = np.maximum.reduceat(second[order], begin) != np.minimum.reduceat(second[order], begin)
    if odd.any():  # equal hashes of different windows
        among = odd[run]
        windows = np.where(among, second[order], 0)
        order = order[np.lexsort((windows, h[order]))]
        change = np.r_[True, (h[order][1:] != h[order][:-1]) | (second[order][1:] != second[order][:-1])]
        begin = np.flatnonzero(change)
        run = np.cumsum(change) - 1
    least = np.minimum.reduceat(docs[order], begin)
    own = docs[order] == least[run]
    top = np.maximum.reduceat(np.where(own, route[order], np.uint16(0)), begin)
    several = np.minimum.reduceat(np.where(own, route[order], np.uint16(0xFFFF)), begin) != top
    place = np.full(len(begin), len(order))
    np.minimum.at(place, run[own], np.flatnonzero(own))
    extra, lost = np.flatnonzero(own & several[run]), np.flatnonzero(~own)
    once = lambda at: at[_distinct(run[at], docs[order[at]], route[order[at]])] if len(at) else at
    return order[np.r_[place[~several], once(extra)]], order[once(lost)]


def _pack(bucket: np.ndarray, records: Records) -> Iterator[tuple[int, bytes]]:
    """Per bucket its records in order of documents: how many documents, their ids, counts and routes, second hashes, hashes."""
    order = np.lexsort((records[3], records[2], bucket))
    bucket, (h, second, docs, route) = bucket[order], _pick(records, order)
    change = np.r_[True, (docs[1:] != docs[:-1]) | (route[1:] != route[:-1]) | (bucket[1:] != bucket[:-1])] if len(docs) else np.zeros(0, bool)
    one = np.flatnonzero(change)
    count = np.diff(np.r_[one, len(docs)]).astype(np.uint32)
    begin, size = _runs(bucket)
    first = np.r_[np.searchsorted(one, begin), len(one)]
    for k, (at, n) in enumerate(zip(begin.tolist(), size.tolist())):
        i, j = first[k], first[k + 1]
        own = one[i:j]
        yield int(bucket[at]), b"".join((np.int64(j - i).tobytes(), docs[own].tobytes(), count[i:j].tobytes(), route[own].tobytes(), second[at : at + n].tobytes(), h[at : at + n].tobytes()))


def _unpack(raw: bytes) -> Records:
    m = int(np.frombuffer(raw, np.int64, 1)[0])
    n = (len(raw) - 8 - 14 * m) // 9
    docs, count, route = (np.frombuffer(raw, kind, m, 8 + at * m) for kind, at in ((np.int64, 0), (np.uint32, 8), (np.uint16, 12)))
    second, h = np.frombuffer(raw, np.uint8, n, 8 + 14 * m), np.frombuffer(raw, U, n, 8 + 14 * m + n)
    return h, second, np.repeat(docs, count), np.repeat(route, count)


def _batches(rows: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), ROWS_AT_ONCE):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[at : at + ROWS_AT_ONCE]), _PACKED)], schema=_PACKED)


def _part(records: Records, n_parts: int) -> np.ndarray:
    """The part of the documents that a record's document is in."""
    return (words.mix(records[2].view(U) ^ words.mix(records[3].astype(U))) % U(n_parts)).astype(np.int64)


def _block_rows(pieces: list[Records], buckets: list[np.ndarray], n_parts: int) -> Iterator[pa.RecordBatch]:
    """What a block asks, by buckets of hashes, and what its documents lose to each other, by parts as negative buckets."""
    records, bucket = _joined(pieces), np.concatenate(buckets)
    pieces.clear()
    buckets.clear()
    kept, lost = first_owners(records)
    taken = _pick(records, lost)
    yield from _batches([*_pack(-1 - _part(taken, n_parts), taken), *_pack(bucket[kept], _pick(records, kept))])


def _window_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """Of every run of width words, documents not yet kept apart."""
    return words.mix(words.rolling(words.hashes(data, starts, ends), width, BASE))


def _sender(width: int, n_buckets: int, n_parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: list[Records] = []
        buckets: list[np.ndarray] = []
        held = 0
        for batch in batches:
            data, offsets = common.utf8(batch.column("text"))
            ids, route = batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("route").to_numpy(zero_copy_only=False).astype(np.uint16)
            for i, j in common.chunks(offsets):
                part, local = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                starts, ends, first = words.bounds(part, local)
                at, n_windows = words.window_starts(first, width)
                if not len(at):
                    continue
                second = words.mix(words.rolling(words.hashes(part, starts, ends, 1), width, SECOND_BASE)[at])
                buckets.append((second % U(n_buckets)).astype(np.int64))
                pieces.append((_window_hashes(part, starts, ends, width)[at], (second >> U(56)).astype(np.uint8), np.repeat(ids[i:j], n_windows), np.repeat(route[i:j], n_windows)))
                held += len(at)
                if held >= BLOCK_WINDOWS:
                    yield from _block_rows(pieces, buckets, n_parts)
                    held = 0
        if held:
            yield from _block_rows(pieces, buckets, n_parts)
        common.trim()

    return run


def _by_bucket(batches: Iterator[pa.RecordBatch], take) -> Iterator[pa.RecordBatch]:
    """take(bucket) gives two functions: what to do with some records, and what at the bucket's end."""
    now, add, end = None, None, None
    for batch in batches:
        for bucket, raw in zip(batch.column("bucket").to_pylist(), batch.column("records")):
            if bucket != now:
                if end:
                    yield from end()
                now, (add, end) = bucket, take(bucket)
            yield from add(_unpack(raw.as_buffer()))
    if end:
        yield from end()
    common.trim()


def _receiver(n_parts: int):
    """Of each bucket what documents lose, by parts."""

    def take(bucket: int):
        held: list[Records] = []
        n_held, room = 0, BLOCK_WINDOWS

        def reduce() -> Iterator[pa.RecordBatch]:
            nonlocal n_held, room
            records = _joined(held)
            kept, lost = first_owners(records)
            taken = _pick(records, lost)
            held[:] = [_pick(records, kept)]
            n_held = len(kept)
            room = max(BLOCK_WINDOWS, 2 * n_held)
            yield from _batches(list(_pack(_part(taken, n_parts), taken)))

        def add(records: Records) -> Iterator[pa.RecordBatch]:
            nonlocal n_held
            if bucket < 0:  # lost already
                yield from _batches(list(_pack(np.full(len(records[0]), -1 - bucket), records)))
                return
            held.append(records)
            n_held += len(records[0])
            if n_held > room:
                yield from reduce()

        return add, lambda: reduce() if held else iter(())

    return lambda batches: _by_bucket(batches, take)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each part the hashes that its documents lose, packed per document; a part has no more of them than windows."""

    def take(part: int):
        held: list[Records] = []
        n_held, room = 0, 2 * BLOCK_WINDOWS

        def add(records: Records) -> Iterator[pa.RecordBatch]:
            nonlocal n_held, room
            held.append(records)
            n_held += len(records[0])
            if n_held > room:  # several blocks may have told the same
                joined = _joined(held)
                held[:] = [_pick(joined, _distinct(joined[0], joined[2], joined[3]))]
                n_held = len(held[0][0])
                room = max(2 * BLOCK_WINDOWS, 2 * n_held)
            return iter(())

        def end() -> Iterator[pa.RecordBatch]:
            h, _, docs, route = _joined(held)
            held.clear()
            order = np.lexsort((h, route, docs))
            h, docs, route = h[order], docs[order], route[order]
            new = np.r_[True, (docs[1:] != docs[:-1]) | (route[1:] != route[:-1])]
            fresh = new.copy()
            fresh[1:] |= h[1:] != h[:-1]
            h, docs, route = h[fresh], docs[fresh], route[fresh]
            begin = np.flatnonzero(new[fresh])
            hits = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer((8 * np.r_[begin, len(h)]).astype(np.int32)), pa.py_buffer(h)])
            made = pa.RecordBatch.from_arrays([pa.array(docs[begin]), pa.array(route[begin].astype(np.int32)), hits], schema=_LOSSES)
            for at in range(0, len(made), 4096):
                yield made.slice(at, 4096)

        return add, end

    return _by_bucket(batches, take)


def losses(docs: DataFrame, width: int, n_buckets: int, n_parts: int) -> DataFrame:
    """doc_id, route and hits: the packed hashes of windows that also start in a document of smaller doc_id; staged."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL")
    packed = "bucket long, records binary"
    together = lambda df: df.repartition("bucket").sortWithinPartitions("bucket")
    asked = plain.withColumn("route", _route()).mapInArrow(_sender(width, n_buckets, n_parts), packed)
    taken = together(asked).mapInArrow(_receiver(n_parts), packed)
    return common.stage_table(together(taken).mapInArrow(_gather, "doc_id long, route int, hits binary"), "windows")


def _documents(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, int, np.ndarray, bytes]]:
    """Per row: words, words removed, the removed intervals as edges of word numbers, and the text that stays.

    A removed word takes the white space behind it along.
    """
    data, offsets = common.utf8(batch.column("text"))
    hits = batch.column(HITS).to_pylist()
    for i, j in common.chunks(offsets):
        part, local = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, first = words.bounds(part, local)
        windows = _window_hashes(part, starts, ends, width) if any(hits[i:j]) else None
        for k in range(i, j):
            a, b = int(first[k - i]), int(first[k - i + 1])
            raw = part[local[k - i] : local[k - i + 1]]
            gone = np.zeros(0, np.int64)
            if hits[k] and b - a >= width:
                gone = np.flatnonzero(np.isin(windows[a : b - width + 1], np.frombuffer(hits[k], U)))
            if not len(gone):
                yield b - a, 0, gone, raw.tobytes()
                continue
            cover = words.covered(gone, width, b - a)
            edges = np.flatnonzero(np.diff(np.r_[0, cover.astype(np.int8), 0]))
            begin = np.r_[starts[a:b] - local[k - i], len(raw)]
            stay = np.ones(len(raw), bool)
            for x, y in zip(edges[::2].tolist(), edges[1::2].tolist()):
                stay[begin[x] : begin[y]] = False
            yield b - a, int(cover.sum()), edges, raw[stay].tobytes()


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("removed", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))), ("kept_text", pa.string())])


def _report(width: int, with_text: bool):
    schema = _RESULT if with_text else pa.schema(list(_RESULT)[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(n, gone, hashlib.sha256(b" ".join(kept.split())).hexdigest(), [{"first": int(x), "last": int(y) - 1} for x, y in zip(edges[::2], edges[1::2])], kept if with_text else None) for n, gone, edges, kept in _documents(batch, width)]
            columns = [batch.column("doc_id").cast(pa.int64())]
            for k, field in enumerate(list(schema)[1:]):
                values = [r[k] for r in rows]
                columns.append(pa.array(values, pa.binary()).cast(pa.string()) if field.name == "kept_text" else pa.array(values, field.type))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        common.trim()

    return run


def _rewrite(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(gone, kept) for _, gone, _, kept in _documents(batch, width)]
            changed = pa.array([gone > 0 for gone, _ in rows], pa.bool_())
            text = pc.if_else(changed, pa.array([kept if gone else None for gone, kept in rows], pa.binary()).cast(batch.column("text").type), batch.column("text"))
            names = [n for n in batch.schema.names if n != HITS]
            out = {n: batch.column(n) for n in names} | {"text": text}
            if "n_chars" in out:
                out["n_chars"] = pc.if_else(changed, pc.utf8_length(text).cast(out["n_chars"].type), out["n_chars"])
            yield pa.RecordBatch.from_arrays([out[n] for n in names], names)
        common.trim()

    return run


def _with_hits(docs: DataFrame, width: int) -> DataFrame:
    """docs with the packed hashes that each row loses, or null."""
    common.small_batches(docs.sparkSession)
    n_bytes = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    found = losses(docs, width, max(8, math.ceil(n_bytes / BUCKET_BYTES)), max(8, math.ceil(n_bytes / PART_BYTES)))
    common.release_shuffles(docs.sparkSession)
    own = docs.withColumn(ROUTE, _route())
    joined = own.join(found, (own["doc_id"].cast("long") == found["doc_id"]) & (own[ROUTE] == found["route"]), "left")
    return joined.select(*(own[c] for c in docs.columns), found["hits"].alias(HITS))


def remove_substrings(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """docs, all columns, with the repeated words cut out of text, and n_chars (if there) that of the new text."""
    return _with_hits(docs, width).mapInArrow(_rewrite(width), docs.schema)


def dedup_substrings(docs: DataFrame, width: int = WIDTH, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, removed (first and last word of each interval) and kept_text.

    kept_text is the text without the removed words and the white space that follows them.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ddl = "doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<first: long, last: long>>" + ", kept_text string" * with_text
    return _with_hits(plain, width).mapInArrow(_report(width, with_text), ddl)


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_substrings(common.read_documents(spark, sf_dir), with_text=False)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256", F.size("removed").cast("long").alias("n_intervals"))


OP3_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, CAST(doc_id AS BIGINT) AS doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)
, windows AS (
  SELECT r, doc_id, i, array_to_string(w[i : i + {WIDTH - 1}], ' ') AS k
  FROM (SELECT r, doc_id, w, unnest(range(1, greatest(len(w) - {WIDTH - 1}, 0) + 1)) AS i FROM d WHERE doc_id IS NOT NULL)
), least AS (SELECT k, min(doc_id) AS least FROM windows GROUP BY k)
, lost AS (SELECT r, i FROM windows JOIN least USING (k) WHERE least < doc_id)
, placed AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d)
, marked AS (
  SELECT p.r, p.i, p.word, coalesce(max(l.i) OVER (PARTITION BY p.r ORDER BY p.i ROWS BETWEEN {WIDTH - 1} PRECEDING AND CURRENT ROW), 0) > 0 AS gone
  FROM placed p LEFT JOIN lost l ON p.r = l.r AND p.i = l.i
), edged AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY i), false) AS opens FROM marked)
, told AS (
  SELECT r, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE opens) AS n_intervals, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept
  FROM edged GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256, CAST(coalesce(n_intervals, 0) AS BIGINT) AS n_intervals
FROM d LEFT JOIN told USING (r)
"""
