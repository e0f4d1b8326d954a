"""SimHash near-duplicates with pivot distance tables.

A fingerprint holds, per bit, whether more than half of a text's shingle hashes have it set. Two
fingerprints link at `max_bits` or fewer differing bits. Candidates share four of six bit bands (two
differing bits spoil two bands at most, so none is missed). In each block of candidates a table of
Hamming distances to many pivot fingerprints is made; the triangle inequality says that linked
fingerprints differ by at most `max_bits` in every column, so pairs with a larger coordinate
difference go, and what survives is verified bit by bit. Linked blocks give star edges, not pairs,
and components come from large-star and small-star rounds over staged tables.

Equal fingerprints are one node, so copies never meet pairwise. A block holds at most 2 ** 22
distinct fingerprints (22 free bits); dense blocks are split again by exact sub-bands. Nothing is
capped or dropped.

Defined results: null or word-less text has fingerprint zero and links like any other; fewer words
than `shingle` make one shingle of them all; repeated doc_id rows give one row each; a null doc_id
keeps its row and takes its component's smallest known doc_id, or null if there is none; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codalith.llm import common, words

SEED, N_PIVOTS = 42, 32
_BANDS = [((1 << w) - 1) << s for w, s in ((11, 0), (11, 11), (11, 22), (11, 33), (10, 44), (10, 54))]
#: Bits that the candidates of a block share: every choice of four bands.
MASKS = [sum(x) for x in combinations(_BANDS, 4)]
#: Above so many members, a block is split again before pairs are compared.
DENSE = 256
#: Files of a round of components: so many at least, and one for so many edges.
FEWEST_FILES, FILE_EDGES = 12, 200_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivots(n: int = N_PIVOTS) -> np.ndarray:
    return words.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_hashes(word_list: list[bytes], shingle: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each run of words joined by a space; of all words if there are fewer; none if there are none."""
    if not word_list:
        return np.zeros(0, np.uint64)
    joined = b" ".join(word_list)
    ends = np.cumsum(np.fromiter(map(len, word_list), np.int64, len(word_list)) + 1) - 1
    n = max(1, len(word_list) - shingle + 1)
    starts = np.r_[0, ends[:-1] + 1][:n].tolist()
    stops = ends[min(shingle, len(word_list)) - 1 :].tolist()
    return np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, map(slice, starts, stops)), repeat(seed)), np.uint64, n)


def fingerprint(h: np.ndarray) -> int:
    """Bits set in more than half of the hashes."""
    if not len(h):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 14):
        part = np.ascontiguousarray(h[at : at + (1 << 14)].astype("<u8")).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint16 if len(part) < 65536 else np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = common.utf8(batch.column("text"))
            out = np.empty(len(offsets) - 1, np.int64)
            for i, j in common.chunks(offsets):
                low = _LOWER[data[offsets[i] : offsets[j]]].tobytes()
                for k in range(i, j):
                    word_list = low[offsets[k] - offsets[i] : offsets[k + 1] - offsets[i]].split()
                    out[k] = _signed(fingerprint(shingle_hashes(word_list, shingle)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(out)], ["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint's 64 bits as a signed long."""
    common.small_batches(docs.sparkSession)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(_fingerprints(shingle), "doc_id long, fp long")


def _near(fp: np.ndarray, i: np.ndarray, j: np.ndarray, table: np.ndarray, max_bits: int) -> np.ndarray:
    """Which candidate pairs link: the pivot table discards, then the bits decide."""
    keep = np.ones(len(i), bool)
    for column in table:
        if not keep.any():
            break
        at = np.flatnonzero(keep)
        keep[at] = np.abs(column[i[at]] - column[j[at]]) <= max_bits
    at = np.flatnonzero(keep)
    keep[at] = np.bitwise_count(fp[i[at]] ^ fp[j[at]]) <= max_bits
    return keep


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Length of the run that each position of sorted keys begins, else 0."""
    n = len(keys[0])
    change = np.ones(n, bool)
    if n:
        change[1:] = False
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
    begin = np.flatnonzero(change)
    out = np.zeros(n, np.int64)
    out[begin] = np.diff(np.r_[begin, n])
    return out


def _stars(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest member number that each of n members reaches over the links i, j."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _lag_links(fp: np.ndarray, length: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside short runs; all pairs of a run meet at some lag."""
    run_of = np.repeat(np.flatnonzero(length), length[length > 0])
    left = run_of + length[run_of] - np.arange(len(fp)) - 1  # members after this one in its run
    active = np.flatnonzero(left > 0)
    if not len(active):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    table = np.bitwise_count(fp[None, :] ^ pivots()[:, None]).astype(np.int8)
    found_i, found_j, lag = [], [], 1
    while len(active):
        keep = _near(fp, active, active + lag, table, max_bits)
        found_i.append(active[keep])
        found_j.append(active[keep] + lag)
        lag += 1
        active = active[left[active] >= lag]
    return np.concatenate(found_i), np.concatenate(found_j)


def _dense_links(fp: np.ndarray, free: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links in a block whose members differ in the free bits alone: split by sub-bands, one of which linked members share."""
    bits = [b for b in range(64) if free >> b & 1]
    parts = max_bits + 1
    if len(fp) <= DENSE or len(bits) < 2 * parts:
        return _lag_links(fp, np.r_[len(fp), np.zeros(len(fp) - 1, np.int64)], max_bits)
    out_i, out_j = [], []
    for part in range(parts):
        mask = sum(1 << b for b in bits[part::parts])
        key = fp & np.uint64(mask)
        order = np.argsort(key, kind="stable")
        sub = fp[order]
        length = _runs(key[order])
        large = np.flatnonzero(length > DENSE)
        small = length.copy()
        small[large] = 0
        inside = np.zeros(len(fp), bool)
        for at in large:
            inside[at : at + length[at]] = True
            i, j = _dense_links(sub[at : at + length[at]], free & ~mask, max_bits)
            label = _stars(length[at], i, j)
            moved = np.flatnonzero(label != np.arange(len(label)))
            out_i.append(order[at + label[moved]])
            out_j.append(order[at + moved])
        rest = np.flatnonzero(~inside)
        if len(rest):
            i, j = _lag_links(sub[rest], _runs(key[order][rest]), max_bits)
            out_i.append(order[rest[i]])
            out_j.append(order[rest[j]])
    return np.concatenate(out_i), np.concatenate(out_j)


def _block_edges(max_bits: int):
    def edges(fp: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
        label = _stars(len(fp), i, j) if len(i) else np.arange(len(fp))
        moved = np.flatnonzero(fp[label] != fp)
        a, b = fp.view(np.int64)[label[moved]], fp.view(np.int64)[moved]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def links(mask_no: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        length = _runs(mask_no, key)
        out_i, out_j, inside = [], [], np.zeros(len(fp), bool)
        for at in np.flatnonzero(length > DENSE):
            inside[at : at + length[at]] = True
            i, j = _dense_links(fp[at : at + length[at]], ~MASKS[mask_no[at]] & ((1 << 64) - 1), max_bits)
            out_i.append(at + i)
            out_j.append(at + j)
        rest = np.flatnonzero(~inside)
        i, j = _lag_links(fp[rest], _runs(mask_no[rest], key[rest]), max_bits)
        return edges(fp, np.concatenate([*out_i, rest[i]]), np.concatenate([*out_j, rest[j]]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []  # pieces of the last run, joined once it has ended
        for batch in batches:
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask_no", "key", "fp")]
            if not len(now[0]):
                continue
            if held and all(held[0][k][0] == now[k][0] == now[k][-1] for k in (0, 1)):
                held.append(now)
                continue
            now = [np.concatenate(x) for x in zip(*held, now)]
            last = int(np.flatnonzero(_runs(now[0], now[1]))[-1])  # the last run may go on in the next batch
            held = [[x[last:] for x in now]]
            if last:
                yield links(now[0][:last], now[1][:last], np.ascontiguousarray(now[2][:last]).view(np.uint64))
        if held:
            now = [np.concatenate(x) for x in zip(*held)]
            yield links(now[0], now[1], np.ascontiguousarray(now[2]).view(np.uint64))
        common.trim()

    return run


def fingerprint_links(nodes: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b), a < b: star edges that connect exactly the fingerprints in fp that links connect."""
    if max_bits > 2:
        raise ValueError("six bands, four of them shared, find differences of two bits at most")
    keys = F.array(*[F.struct(F.lit(k).cast("byte").alias("mask_no"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for k, m in enumerate(MASKS)])
    dealt = nodes.select("fp", F.explode(keys).alias("k")).select("k.mask_no", "k.key", "fp")
    blocks = dealt.repartition("mask_no", "key").sortWithinPartitions("mask_no", "key", "fp")
    return blocks.mapInArrow(_block_edges(max_bits), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of edges (a, b) reaches, by large-star and small-star rounds."""
    now = common.stage_table(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum((F.xxhash64("a", "b") / 2).cast("decimal(38,0)"))).first())

    before, done = state(now), now
    while before[0]:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        now = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        least = now.groupBy("b").agg(F.min("a").alias("m"))
        joined = now.join(least, "b")
        now = joined.select(F.col("m").alias("a"), F.col("a").alias("b")).union(joined.select(F.col("m").alias("a"), "b")).where("a <> b").distinct()
        # Rounds leave few edges, which need no file for each partition of a shuffle.
        old, now = done, common.stage_table(now.coalesce(max(FEWEST_FILES, before[0] // FILE_EDGES)), "edges")
        common.drop_table(old)
        done, after = now, state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("b").alias("node"), F.col("a").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, fingerprint, component_id (the smallest doc_id that links reach, its own included)."""
    own = common.stage_table(fingerprints(docs, shingle), "fingerprints")
    nodes = own.groupBy("fp").agg(F.min("doc_id").alias("first"))
    linked = components(fingerprint_links(nodes.select("fp"), max_bits))
    rooted = nodes.join(linked, nodes["fp"] == linked["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    known = rooted.join(least, "root").select("fp", "component_id")
    return own.join(known, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """docs, all columns, without those that a document of smaller doc_id stands for; rows of null doc_id stay."""
    found = near_duplicates(docs, shingle, max_bits)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("__codalith_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__codalith_gone"], "left_anti")


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(common.read_documents(spark, sf_dir))
