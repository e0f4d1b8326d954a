"""Benchmark decontamination by a distributed positional inverted index.

The index has a row for each block of documents (some megabytes of text, whole documents): its terms,
and for each term the ascending places where it stands in the block. It is built once, without a
shuffle, stored, and asked by phrases or for proximity. Every block answers for itself: phrases that
lack a term there are left out at once; the rest begin with the list of their rarest term, moved by
its offset in the phrase, and are intersected with the moved lists of the other terms from the rarer
to the more frequent one. Lists are compared for all phrases together, a million places at a time.

The test items are a stated query set. They are taken in slabs of SLAB_BYTES of text (one longer item
goes alone), which is what is broadcast; each slab is one pass over the index. Answers of several slabs
for a document are put together by the document's place in the index.

Terms are found by hash and compared by their bytes. A term is [0-9a-z] or any character above ASCII,
one or more of them, with A-Z lower-cased.

Defined results: null and term-less texts have no words and are never hit; an item without words asks
nothing; an item of fewer words than `width` asks for all of them as one phrase; rows that share a
doc_id get a row each; items that share an item_id count as one; an item of null item_id marks words,
but has no name to be counted or listed by; without documents there are no rows, without items no hits;
other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codalith.llm import common, words

U = np.uint64
WIDTH = 10
#: Text bytes of a block of documents and of a slab of items, and candidate places that are compared at once.
BLOCK_BYTES, SLAB_BYTES, CANDIDATES = 6 << 20, 4 << 20, 1 << 20
#: Bytes of a row group of the index, since a writer and a reader hold one whole. Parquet's writer compares its bytes only after
#: so many rows (100 unless told otherwise, which would be 700 MB of blocks), so it is told to look at every row and to end after a few.
GROUP_BYTES, GROUP_ROWS = 16 << 20, 2
_GROUPS = {"parquet.block.size": str(GROUP_BYTES), "parquet.block.row.count.limit": str(GROUP_ROWS), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_APART = np.ones(256, bool)
_APART[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False

_INDEX = "block long, seeds int, ids binary, known binary, firsts binary, keys binary, sizes binary, counts binary, places binary, pool binary"


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased bytes, starts and ends of all terms, and the number of each text's first term."""
    low = _LOWER[data]
    return low, *words.bounds(low, offsets, _APART)


@dataclass
class Block:
    """The positional index of some documents."""

    number: int
    seeds: int
    ids: np.ndarray  # doc_ids
    known: np.ndarray  # whether they aren't null
    firsts: np.ndarray  # place of each document's first word, and of the end
    keys: np.ndarray  # sorted hashes of the terms
    ends: np.ndarray  # of the terms in pool
    counts: np.ndarray
    places: np.ndarray  # of term after term, ascending
    pool: np.ndarray

    @staticmethod
    def of(number: int, data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, known: np.ndarray) -> Block:
        low, starts, ends, firsts = terms_of(data, offsets)
        keys, seeds = words.hashes(low, starts, ends), 1
        order = np.argsort(keys, kind="stable")
        equal = keys[order[1:]] == keys[order[:-1]]
        one, other = order[:-1][equal], order[1:][equal]
        if not words.same(low, starts[one], ends[one], low, starts[other], ends[other]).all():
            keys, seeds = words.exact_by_seeds(low, starts, ends)
            order = np.argsort(keys, kind="stable")
            equal = keys[order[1:]] == keys[order[:-1]]
        begin = np.flatnonzero(np.r_[True, ~equal]) if len(order) else order
        leader = order[begin]
        size = ends[leader] - starts[leader]
        return Block(number, seeds, ids, known, firsts, keys[leader], np.cumsum(size), np.diff(np.r_[begin, len(order)]), order, words.gather(low, starts[leader], size))

    def row(self) -> tuple:
        """For the index's table; places as distances, which pack well."""
        begin = np.cumsum(self.counts) - self.counts
        apart = np.diff(self.places, prepend=0)
        apart[begin] = self.places[begin]
        short = len(self.places) < 1 << 32
        return (
            self.number, self.seeds, *(x.tobytes() for x in (self.ids, self.known, self.firsts, self.keys)), np.diff(self.ends, prepend=0).tobytes(),
            self.counts.tobytes(), apart.astype(np.uint32 if short else np.int64).tobytes(), self.pool.tobytes(),
        )

    @staticmethod
    def read(row: dict) -> Block:
        number = lambda k, kind=np.int64: np.frombuffer(row[k], kind)
        counts = number("counts")
        total = int(counts.sum())
        apart = number("places", np.uint32 if total < 1 << 32 else np.int64).astype(np.int64)
        summed = np.cumsum(apart)
        begin = np.cumsum(counts) - counts
        places = summed - np.repeat(summed[begin] - apart[begin], counts)
        return Block(row["block"], row["seeds"], number("ids"), number("known", bool), number("firsts"), number("keys", U), np.cumsum(number("sizes")), counts, places, number("pool", np.uint8))

    def find(self, asked: Terms) -> np.ndarray:
        """The number of each asked term here, or -1."""
        out, rest = np.full(len(asked.starts), -1, np.int64), np.arange(len(asked.starts))
        if not len(self.keys):
            return out
        begin = self.ends - np.diff(self.ends, prepend=0)
        for seed in range(self.seeds):
            hashed = asked.keys[rest] if not seed else words.hashes(asked.data, asked.starts[rest], asked.ends[rest], seed)
            at = np.minimum(np.searchsorted(self.keys, hashed), len(self.keys) - 1)
            there = self.keys[at] == hashed
            there[there] = words.same(asked.data, asked.starts[rest[there]], asked.ends[rest[there]], self.pool, begin[at[there]], self.ends[at[there]])
            out[rest[there]] = at[there]
            rest = rest[~there]
        return out

    @functools.cached_property
    def bounds(self) -> np.ndarray:
        """Where each term's list begins in places."""
        return np.r_[0, np.cumsum(self.counts)]

    @functools.cached_property
    def postings(self) -> np.ndarray:
        """Term number and place in one sorted number, to look many of them up at once."""
        return (np.repeat(np.arange(len(self.counts)), self.counts) << 36) | self.places

    def holds(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Which terms stand at the places beside them."""
        asked = (term << 36) | place
        at = np.minimum(np.searchsorted(self.postings, asked), len(self.postings) - 1)
        return self.postings[at] == asked

    def document(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.firsts, place, side="right") - 1


@dataclass
class Terms:
    """The distinct terms of some items."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    keys: np.ndarray

    @staticmethod
    def of(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[Terms, np.ndarray]:
        """The terms, and the number of each word's term."""
        _, first, which = np.unique(words.exact(low, starts, ends), return_index=True, return_inverse=True)
        starts, ends = starts[first], ends[first]
        size = ends - starts
        pool = words.gather(low, starts, size)
        stop = np.cumsum(size)
        return Terms(pool, stop - size, stop, words.hashes(pool, stop - size, stop)), which


@dataclass
class Phrases:
    """Distinct phrases as rows of term numbers, filled up with -1, and the items that have them."""

    terms: Terms
    rows: np.ndarray
    length: np.ndarray
    first: np.ndarray  # of each phrase's part of items
    items: np.ndarray  # item numbers
    names: list[str | None]

    @staticmethod
    def of(texts: pa.Array, names: list[str | None], width: int) -> Phrases:
        low, starts, ends, first = terms_of(*common.utf8(texts))
        terms, which = Terms.of(low, starts, ends)
        distinct = {name: k for k, name in enumerate(dict.fromkeys(names))}
        number = np.array([distinct[name] for name in names], np.int64)
        rows, owner = [np.zeros((0, width), np.int64)], [np.zeros(0, np.int64)]
        at, n_windows = words.window_starts(first, width)
        if len(at):
            rows.append(which[at[:, None] + np.arange(width)])
            owner.append(np.repeat(number, n_windows))
        size = np.diff(first)
        for k in np.flatnonzero((size > 0) & (size < width)).tolist():
            rows.append(np.r_[which[first[k] : first[k + 1]], np.full(width - size[k], -1)][None])
            owner.append(number[k : k + 1])
        rows, owner = np.concatenate(rows), np.concatenate(owner)
        if not len(rows):
            return Phrases(terms, rows, np.zeros(0, np.int64), np.zeros(1, np.int64), owner, list(distinct))
        phrases, phrase = np.unique(rows, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([phrase.ravel(), owner]), axis=1)
        return Phrases(terms, phrases, (phrases >= 0).sum(axis=1), np.searchsorted(pairs[0], np.arange(len(phrases) + 1)), pairs[1], list(distinct))

    def search(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Phrase numbers and first places of all occurrences in block."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(self.rows) or not len(block.keys):
            return none
        here = np.r_[block.find(self.terms), -2]  # the last one is what fills up
        rows = here[self.rows]
        alive = np.flatnonzero((rows != -1).all(axis=1))
        if not len(alive):
            return none
        rows = rows[alive]
        often = np.where(rows >= 0, block.counts[np.maximum(rows, 0)], np.iinfo(np.int64).max)
        rarest_first = np.argsort(often, axis=1, kind="stable")
        start_at = rarest_first[:, 0]
        lead = rows[np.arange(len(rows)), start_at]
        count = block.counts[lead]
        found_phrase, found_place = [], []
        edges = np.r_[0, np.cumsum(count)]
        i = 0
        while i < len(rows):
            j = max(i + 1, int(np.searchsorted(edges, edges[i] + CANDIDATES, side="right")) - 1)
            for a in range(0, int(edges[j] - edges[i]), 2 * CANDIDATES):  # one list may be longer
                part = np.arange(a, min(a + 2 * CANDIDATES, int(edges[j] - edges[i])))
                phrase = i + np.searchsorted(edges[i + 1 : j + 1] - edges[i], part, side="right")
                place = block.places[block.bounds[lead[phrase]] + part - (edges[phrase] - edges[i])] - start_at[phrase]
                keep = place >= 0
                phrase, place = phrase[keep], place[keep]
                for k in range(1, rows.shape[1]):
                    offset = rarest_first[phrase, k]
                    term = rows[phrase, offset]
                    keep = term < 0
                    keep[~keep] = block.holds(term[~keep], place[~keep] + offset[~keep])
                    phrase, place = phrase[keep], place[keep]
                    if not len(phrase):
                        break
                found_phrase.append(phrase)
                found_place.append(place)
            i = j
        phrase, place = np.concatenate(found_phrase), np.concatenate(found_place)
        whole = block.document(place) == block.document(place + self.length[alive[phrase]] - 1)
        return alive[phrase[whole]], place[whole]

    def names_of(self, phrases: np.ndarray) -> list[str]:
        """The items that have any of some distinct phrases."""
        count = self.first[phrases + 1] - self.first[phrases]
        found = np.unique(words.gather(self.items, self.first[phrases], count))
        return [self.names[k] for k in found.tolist() if self.names[k] is not None]


def build_index(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The positional index of all texts of docs (doc_id, text): a row for each block of whole documents; staged."""
    common.small_batches(docs.sparkSession)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    names = [x.split()[0] for x in _INDEX.split(", ")]
    types = [pa.int64(), pa.int32(), *[pa.binary()] * 8]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, []

        def rows() -> Iterator[pa.RecordBatch]:
            nonlocal number
            data, size, ids, known = (np.concatenate(x) for x in zip(*held))
            held.clear()
            row = Block.of(number, data, np.r_[0, np.cumsum(size)], ids, known).row()
            number += 1
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names)

        for batch in batches:
            data, offsets = common.utf8(batch.column("text"))
            ids, known = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False), batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            for i, j in common.chunks(offsets, block_bytes):
                held.append((data[offsets[i] : offsets[j]], np.diff(offsets[i : j + 1]), ids[i:j], known[i:j]))
                if sum(len(x[0]) for x in held) >= block_bytes:
                    yield from rows()
        if held:
            yield from rows()
        common.trim()

    return common.stage_table(plain.mapInArrow(run, _INDEX), "index", _GROUPS)


def _slabs(items: DataFrame, slab_bytes: int) -> Iterator[pa.Table]:
    """The items (name, text), in tables of about slab_bytes of text each: what one pass broadcasts. Without items one empty table."""
    staged = common.stage_table(items.select(F.col("item_id").cast("string").alias("name"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull()), "items")
    n_bytes = staged.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n_slabs = max(1, -(-2 * n_bytes // slab_bytes)) if n_bytes > slab_bytes else 1  # by hash, so half full on average
    for k in range(n_slabs):
        yield staged.where(F.pmod(F.xxhash64("name", "text"), F.lit(n_slabs)) == k).toArrow()
    common.drop_table(staged)


def _each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        names = batch.schema.names
        for k in range(batch.num_rows):
            yield Block.read({name: batch.column(c)[k].as_py() if c < 2 else batch.column(c)[k].as_buffer() for c, name in enumerate(names)})


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
_FOUND = "block long, k long, doc_id long, n_words long, spans array<struct<first: long, last: long>>, items array<string>"


def _searching(phrases, every: bool):
    """Of each block the documents that are hit, or every one: merged spans of their words and the items found in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Phrases = phrases.value
        for block in _each_block(batches):
            phrase, place = asked.search(block)
            n = len(block.ids)
            step = np.zeros(int(block.firsts[-1]) + 1, np.int64)
            np.add.at(step, place, 1)
            np.add.at(step, place + asked.length[phrase], -1)
            inside = np.cumsum(step[:-1]) > 0
            edge = np.diff(np.r_[0, inside.astype(np.int8), 0])
            begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            # a run of hits in neighbouring documents is one of each
            cuts = np.setdiff1d(block.firsts[1:-1], np.r_[begin, end])
            cuts = cuts[inside[np.minimum(cuts, max(0, len(inside) - 1))]] if len(inside) else cuts[:0]
            begin, end = np.sort(np.r_[begin, cuts]), np.sort(np.r_[end, cuts])
            owner = block.document(begin)
            pairs = np.unique((block.document(place) << 32) | phrase)
            hit, at = np.unique(pairs >> 32, return_index=True)
            items = {d: asked.names_of(part & 0xFFFFFFFF) for d, part in zip(hit.tolist(), np.split(pairs, at[1:]))} if len(hit) else {}
            which = np.arange(n) if every else hit
            lo, hi = np.searchsorted(owner, which), np.searchsorted(owner, which, side="right")
            first = block.firsts[which]
            spans = [[{"first": int(a - f), "last": int(b - 1 - f)} for a, b in zip(begin[x:y].tolist(), end[x:y].tolist())] for x, y, f in zip(lo.tolist(), hi.tolist(), first.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(which), block.number)), pa.array(which), pa.array(block.ids[which], mask=~block.known[which]), pa.array(block.firsts[which + 1] - first), pa.array(spans, _SPANS), pa.array([items.get(d, []) for d in which.tolist()], pa.list_(pa.string()))],
                ["block", "k", "doc_id", "n_words", "spans", "items"],
            )
        common.trim()

    return run


def merged(spans: list[dict]) -> list[dict]:
    """Spans of words in order, those that overlap or meet joined."""
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: s["first"]):
        if out and s["first"] <= out[-1]["last"] + 1:
            out[-1]["last"] = max(out[-1]["last"], s["last"])
        else:
            out.append(dict(s))
    return out


def _merging(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = pa.array([merged(x) for x in batch.column("spans").to_pylist()], _SPANS)
        yield pa.RecordBatch.from_arrays([spans if name == "spans" else batch.column(name) for name in batch.schema.names], batch.schema.names)


def phrase_matches(index: DataFrame, items: DataFrame, width: int = WIDTH, slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """For each document doc_id, n_words, spans (first and last word of each maximal run of hit words) and items found in it, sorted.

    items is (item_id, text); every run of width words of an item is a phrase.
    """
    spark, found, n = index.sparkSession, None, 0
    common.small_batches(spark)
    for slab in _slabs(items, slab_bytes):
        asked = spark.sparkContext.broadcast(Phrases.of(slab.column("text"), slab.column("name").to_pylist(), width))
        part = index.mapInArrow(_searching(asked, not n), _FOUND)
        found, n = part if found is None else found.unionAll(part), n + 1
    if n > 1:
        found = found.groupBy("block", "k").agg(F.first("doc_id", ignorenulls=True).alias("doc_id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
        found = found.mapInArrow(_merging, _FOUND)
    return found.select("doc_id", "n_words", "spans", F.array_sort(F.array_distinct("items")).alias("items"))


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """For each document doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans and items."""
    found = phrase_matches(build_index(docs), items, width)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "spans", "items")


def _near(block: Block, terms: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest runs of at most within words of one document that hold all of some terms: first and last places."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    lists = sorted((block.places[block.bounds[t] : block.bounds[t + 1]] for t in terms.tolist()), key=len)
    rare = lists[0]
    if not len(rare):
        return none
    # runs end near a place of the rarest term; everything else needn't be looked at
    near = [rare]
    for places in lists[1:]:
        before = rare[np.maximum(np.searchsorted(rare, places, side="right") - 1, 0)]
        after = rare[np.minimum(np.searchsorted(rare, places), len(rare) - 1)]
        near.append(places[((places - before >= 0) & (places - before < within)) | ((after - places >= 0) & (after - places < within))])
        if not len(near[-1]):
            return none
    last = np.unique(np.concatenate(near))
    first = last.copy()
    for places in near:
        at = np.searchsorted(places, last, side="right") - 1
        first = np.minimum(first, np.where(at >= 0, places[np.maximum(at, 0)], -1))
    keep = (first >= 0) & (last - first < within)
    first, last = first[keep], last[keep]
    keep = block.document(first) == block.document(last)
    first, last = first[keep], last[keep]
    least = np.r_[True, first[1:] != first[:-1]] if len(first) else np.zeros(0, bool)  # of runs with one beginning the shortest
    return first[least], last[least]


def proximity_matches(index: DataFrame, items: DataFrame, within: int, slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """(doc_id, item_id as a string, first, last): the smallest runs of at most within words that hold every distinct term of an item."""
    spark, found = index.sparkSession, None
    common.small_batches(spark)

    def searching(asked):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            terms, queries, names = asked.value
            for block in _each_block(batches):
                here = block.find(terms)
                for query, name in zip(queries, names):
                    numbers = here[query]
                    if not len(numbers) or (numbers < 0).any():
                        continue
                    first, last = _near(block, numbers, within)
                    doc = block.document(first)
                    shift = block.firsts[doc]
                    yield pa.RecordBatch.from_arrays([pa.array(block.ids[doc], mask=~block.known[doc]), pa.array([name] * len(doc), pa.string()), pa.array(first - shift), pa.array(last - shift)], ["doc_id", "item_id", "first", "last"])
            common.trim()

        return run

    for slab in _slabs(items, slab_bytes):
        low, starts, ends, first = terms_of(*common.utf8(slab.column("text")))
        terms, which = Terms.of(low, starts, ends)
        queries = [np.unique(which[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
        asked = spark.sparkContext.broadcast((terms, queries, slab.column("name").to_pylist()))
        part = index.mapInArrow(searching(asked), "doc_id long, item_id string, first long, last long")
        found = part if found is None else found.unionAll(part)
    return found


def op12_decontaminate(spark, sf_dir: str) -> DataFrame:
    out = contamination(common.read_documents(spark, sf_dir), common.table(spark, sf_dir, "benchmark"))
    return out.drop("spans", "items")


OP12_SQL = rf"""
WITH words AS (SELECT translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x, r, doc_id FROM (SELECT row_number() OVER () AS r, CAST(doc_id AS BIGINT) AS doc_id, coalesce(text, '') AS x FROM documents))
, d AS (SELECT r, doc_id, regexp_extract_all(x, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM words)
, b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), asked AS (
  SELECT DISTINCT item_id, least(len(w), {WIDTH}) AS n, array_to_string(w[i : i + least(len(w), {WIDTH}) - 1], ' ') AS k
  FROM (SELECT *, unnest(range(1, greatest(len(w) - {WIDTH} + 1, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), windows AS (
  SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS k
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM asked) WHERE len(w) >= n)
), hits AS (SELECT r, i, n, item_id FROM windows JOIN asked USING (n, k))
, marked AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS at FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r)
, named AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names FROM (SELECT DISTINCT r, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (r) LEFT JOIN named USING (r)
"""
