"""A Merkle manifest of a dataset: a leaf for each row, a tree for each source, a tree over the sources' roots, and proofs.

Rows become leaf digests in the JVM; only digests travel from there on. Leaves are range-partitioned
and numbered by (source, doc_id), so a source of any size is dealt over many tasks. Trees grow by
events: a child digest goes to a slot of its partial parent; when as many slots are filled as the
group's size says the parent has, the parent is hashed, leaves the store and becomes an event itself.
What a task can't resolve, the frontier, is one node for ARITY ** DEPTH below it; it is shuffled again
by the ancestor of the next DEPTH levels, until each group is one node. On the way each node keeps the
link back to its run (place and siblings); from the root downwards the links are put together, one row
for each subtree of leaves, and meet the leaves once more, where proofs are read off and folded.

No task holds more than the open parents of one path, or one subtree with its path. Nothing of the
rows comes to the driver but the largest group's size, the number of sources and the root. A source
with few rows costs one path of at most 15 digests a level.

Defined results: null columns count as `-` in a leaf; leaves of one doc_id are ordered by their digests
(equal ones are equal rows, so their order changes nothing); null doc_ids come first and are never
tampered with; a null source is a source of its own, before the empty one; no rows give no rows;
a lone leaf is its source's root, and a lone source's root is the root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codalith.llm import common

#: Children of a node, and levels that one task resolves.
ARITY, DEPTH = 16, 3
SPAN = ARITY**DEPTH
#: What is signed, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 5
_HEX = 64


def parents_of(n):
    """How many parents n nodes have."""
    return (n + ARITY - 1) // ARITY


def sha(raw: bytes) -> bytes:
    """Lower-case hex SHA-256."""
    return hashlib.sha256(raw).hexdigest().encode()


class Tree:
    """Partial parents of one group: digests of children by place, until a parent has all that the group's size gives it."""

    def __init__(self, n: int, depth: int = DEPTH):
        self.counts = [n]
        while len(self.counts) <= depth and self.counts[-1] > 1:
            self.counts.append(parents_of(self.counts[-1]))
        self.open: dict[tuple[int, int], dict[int, bytes]] = {}
        self.runs: dict[tuple[int, int], bytes] = {}
        self.tops: list[tuple[int, int, bytes]] = []

    def add(self, index: int, digest: bytes) -> None:
        """The event of one node; it may set off its ancestors' events."""
        for level, count in enumerate(self.counts[:-1]):
            parent = index // ARITY
            slots = self.open.setdefault((level, parent), {})
            slots[index % ARITY] = digest
            if len(slots) < min(ARITY, count - parent * ARITY):
                return
            run = b"".join(slots[k] for k in range(len(slots)))
            del self.open[level, parent]
            self.runs[level, parent] = run
            index, digest = parent, sha(run)
        self.tops.append((index, self.counts[-1], digest))

    def links(self, index: int) -> list[tuple[int, bytes]]:
        """A base node's place in its run and the run, level by level."""
        out = []
        for level in range(len(self.counts) - 1):
            out.append((index % ARITY, self.runs[level, index // ARITY]))
            index //= ARITY
        return out


def pack_links(links: list[tuple[int, bytes]]) -> bytes:
    return b"".join(bytes((place, len(run) // _HEX)) + bytes.fromhex(run.decode()) for place, run in links)


def unpack_links(raw: bytes) -> list[tuple[int, bytes]]:
    out, at = [], 0
    while at < len(raw):
        end = at + 2 + raw[at + 1] * _HEX // 2
        out.append((raw[at], raw[at + 2 : end].hex().encode()))
        at = end
    return out


def siblings(place: int, run: bytes) -> bytes:
    return run[: place * _HEX] + run[(place + 1) * _HEX :]


def fold(digest: bytes, links: list[tuple[int, bytes]]) -> bytes:
    """The root that a digest and the siblings beside its way give."""
    for place, run in links:
        digest = sha(run[: place * _HEX] + digest + run[(place + 1) * _HEX :])
    return digest


def leaf_digest(columns: dict[str, Column]) -> Column:
    """A row's leaf as 32 bytes."""
    told = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*(told(columns[name]) for name in FIELDS)).cast("binary"), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, bad, salt): the leaf of each row, and that of its tampered text where doc_id's hash says so."""
    columns = {name: F.col(name).cast("long").cast("string") if name in ("doc_id", "n_chars") else F.col(name).cast("string") for name in FIELDS}
    lowered = columns | {"text": F.translate(columns["text"], string.ascii_uppercase, string.ascii_lowercase)}
    chosen = F.crc32(columns["doc_id"].cast("binary")) % TAMPER_EVERY == 0
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), columns["source"].alias("source"), leaf_digest(columns).alias("leaf"),
        F.when(chosen, leaf_digest(lowered)).alias("bad"), F.monotonically_increasing_id().alias("salt"),
    )


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to rows sorted by source the place of each among the task's rows of its source."""
    last, at = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = pc.dictionary_encode(batch.column("source"), null_encoding="encode").indices.to_numpy()
        begin = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        place = np.arange(len(codes)) - np.repeat(begin, np.diff(np.r_[begin, len(codes)]))
        ends = (batch.column("source")[0].as_py(), batch.column("source")[len(codes) - 1].as_py())
        if last == (ends[0],):
            place[: begin[1] if len(begin) > 1 else len(codes)] += at
        last, at = (ends[1],), int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64())], [*batch.schema.names, "place"])


def ordered_leaves(found: DataFrame) -> DataFrame:
    """(doc_id, leaf, bad, g, i, n, source): each leaf with its source's number, its place there and its source's size; staged."""
    staged = common.stage_table(found, "leaves")
    keys = ["source", "doc_id", "leaf", "salt"]
    dealt = staged.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("pid", F.spark_partition_id())
    plain = "doc_id long, source string, leaf binary, bad binary, pid int"
    placed = common.stage_table(dealt.select("doc_id", "source", "leaf", "bad", "pid").mapInArrow(_numbered, plain + ", place long"), "placed")
    common.drop_table(staged)
    by_source = Window.partitionBy("source").orderBy("pid")
    runs = placed.groupBy("pid", "source").agg((F.max("place") + 1).alias("size"))
    runs = runs.select("pid", "source", (F.sum("size").over(by_source) - F.col("size")).alias("base"), F.sum("size").over(Window.partitionBy("source")).alias("n"))
    runs = common.stage_table(runs, "runs")
    first = runs.where("base = 0")
    before = first.groupBy("pid").count().select(F.col("pid").alias("p"), (F.sum("count").over(Window.orderBy("pid")) - F.col("count")).alias("before"))  # a row for each task
    numbers = first.withColumn("own", F.row_number().over(Window.partitionBy("pid").orderBy(F.col("source").asc_nulls_first())) - 1)
    numbers = numbers.join(before, F.col("pid") == F.col("p")).select(F.col("source").alias("s"), (F.col("own") + F.col("before")).alias("g"))
    runs = runs.join(numbers, F.col("source").eqNullSafe(F.col("s"))).select(F.col("pid").alias("q"), F.col("source").alias("s"), "base", "n", "g")
    joined = placed.join(runs, (F.col("pid") == F.col("q")) & F.col("source").eqNullSafe(F.col("s")))
    out = common.stage_table(joined.select("doc_id", "leaf", "bad", "g", (F.col("base") + F.col("place")).alias("i"), "n", "source"), "nodes")
    common.drop_table(placed)
    return out


def _subtree() -> Column:
    return F.floor(F.col("i") / SPAN).cast("long")


def _climbing(with_links: bool):
    """Rows (g, i, n, digest), together by subtree and sorted, to those of the nodes DEPTH levels above; with_links also what leads from each row there."""
    schema = pa.schema([("g", pa.int64()), ("i", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("links", pa.binary())])

    def told(g: int, tree: Tree, held: list[int]) -> Iterator[tuple]:
        assert not tree.open and len(tree.tops) == 1, "a subtree lacks nodes"
        index, count, digest = tree.tops[0]
        yield g, index, count, bytes.fromhex(digest.decode()), None
        for i in held:
            yield g, i, tree.counts[0], None, pack_links(tree.links(i))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tree, held, out = None, None, [], []
        for batch in batches:
            for g, i, n, digest in zip(*(batch.column(k).to_pylist() for k in ("g", "i", "n", "digest"))):
                if now != (g, i // SPAN):
                    if tree:
                        out += told(now[0], tree, held)
                    now, tree, held = (g, i // SPAN), Tree(n), []
                tree.add(i, digest.hex().encode())
                if with_links:
                    held.append(i)
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
        if tree:
            out += told(now[0], tree, held)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def climb(nodes: DataFrame, largest: int, with_links: bool) -> tuple[DataFrame, list[DataFrame]]:
    """The root of each group as (g, digest), and for every round (g, i, n, links); with_links says whether for the first one too.

    nodes has (g, i, n, digest): group, place, number of the group's nodes. Frontiers are staged, as many as the largest group has rounds.
    """
    rounds, tops = [], None
    links = with_links
    while True:
        dealt = nodes.select("g", "i", "n", "digest").repartition(F.col("g"), _subtree()).sortWithinPartitions("g", "i")
        made = common.stage_table(dealt.mapInArrow(_climbing(links), "g long, i long, n long, digest binary, links binary"), "frontier")
        if links:
            rounds.append(made.where("links IS NOT NULL").select("g", "i", "n", "links"))
        made = made.where("digest IS NOT NULL")
        done = made.where("n = 1").select("g", "digest")
        tops = done if tops is None else tops.unionAll(done)
        largest = -(-largest // SPAN)
        if largest <= 1:
            return tops, rounds
        nodes, links = made.where("n > 1"), True


def descend(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """(g, j, links): what leads from the nodes below the first of rounds to what above gives for each group, (g, links)."""
    up = above.select("g", F.lit(0).cast("long").alias("j"), "links")
    for inner in reversed(rounds):
        inner = inner.select(F.col("g").alias("h"), "i", F.col("links").alias("own"))
        # a group that isn't in this round had one node before it already
        both = up.join(inner, (F.col("g") == F.col("h")) & (F.col("j") == F.floor(F.col("i") / SPAN).cast("long")), "left")
        up = both.select("g", F.coalesce("i", "j").alias("j"), F.concat(F.coalesce("own", F.lit(b"")), "links").alias("links"))
    return up


_PROOF = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string, tampered boolean, source string, position long"


def _proving(with_proof: bool):
    """Leaves of a subtree behind the row of its way up, to proofs."""
    schema = pa.schema([("doc_id", pa.int64()), *((k, pa.string()) for k in ("leaf", "subroot", "proof_sha256", "folded_root")), ("tampered", pa.bool_()), ("source", pa.string()), ("position", pa.int64())])
    if with_proof:
        schema = schema.append(pa.field("proof", pa.binary()))

    def told(rows: list[tuple], up: list[tuple[int, bytes]]) -> Iterator[tuple]:
        n = rows[0][5]
        tree = Tree(n)
        for row in rows:
            tree.add(row[4], row[1].hex().encode())
        levels = 0  # inside the source
        while n > 1:
            n, levels = parents_of(n), levels + 1
        beside = b"".join(siblings(*x) for x in up)
        subroot = None
        for doc_id, leaf, bad, _, i, _, source in rows:
            links = tree.links(i)
            own, signed = leaf.hex().encode(), (bad or leaf).hex().encode()
            if subroot is None:
                subroot = fold(own, (links + up)[:levels]).decode()
            proof = sha(b"".join(siblings(*x) for x in links) + beside)
            row = doc_id, own.decode(), subroot, proof.decode(), fold(signed, links + up).decode(), bad is not None, source, i
            yield (*row, pack_links(links + up)) if with_proof else row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, up = None, [], []
        for batch in batches:
            out = []
            columns = [batch.column(k).to_pylist() for k in ("doc_id", "leaf", "bad", "g", "i", "n", "source", "part", "links")]
            for *row, part, links in zip(*columns):
                if now != (row[3], part):
                    if rows:
                        out += told(rows, up)
                    now, rows = (row[3], part), []
                if links is not None:
                    up = unpack_links(links)
                else:
                    rows.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if rows:
            out = list(told(rows, up))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def manifest(docs: DataFrame, with_proof: bool = False) -> DataFrame:
    """For every row of docs doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, tampered, source and position.

    with_proof adds the proof itself: for each level a byte of the place in the run, a byte of the run's size and the run's
    digests. verify() reads it.
    """
    nodes = ordered_leaves(leaves(docs))
    about = nodes.agg(F.max("n").alias("largest"), (F.max("g") + 1).alias("sources")).first()
    tops, rounds = climb(nodes.select("g", "i", "n", F.col("leaf").alias("digest")), about["largest"] or 0, False)
    n_sources = about["sources"] or 0
    base = tops.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("i"), F.lit(n_sources).cast("long").alias("n"), "digest")
    roots, above = climb(base, n_sources, True)
    root = roots.select(F.hex("digest")).first()  # one row
    ways = descend(above, roots.select("g", F.lit(b"").alias("links"))).select(F.col("j").alias("g"), "links")
    up = common.stage_table(descend(rounds, ways), "ways").select(*(F.lit(None).cast(kind).alias(name) for name, kind in (("doc_id", "long"), ("leaf", "binary"), ("bad", "binary"))), "g", F.lit(-1).cast("long").alias("i"), F.lit(None).cast("long").alias("n"), F.lit(None).cast("string").alias("source"), F.col("j").alias("part"), "links")
    rows = nodes.select("doc_id", "leaf", "bad", "g", "i", "n", "source", _subtree().alias("part"), F.lit(None).cast("binary").alias("links"))
    dealt = up.unionByName(rows).repartition("g", "part").sortWithinPartitions("g", "part", "i")
    proofs = dealt.mapInArrow(_proving(with_proof), _PROOF + ", proof binary" * with_proof)
    whole = F.lit(root[0].lower() if root else None)
    return proofs.select("doc_id", "leaf", "subroot", whole.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == whole).alias("verified"), "tampered", "source", "position", *["proof"] * with_proof)


def verify(docs: DataFrame, proofs: DataFrame, root: str) -> DataFrame:
    """(doc_id, verified): whether each row of docs, with the proof that proofs (doc_id, proof) has for it, gives root.

    A row without a proof isn't verified; of several proofs for a doc_id one that gives the root is enough.
    """
    found = leaves(docs).select("doc_id", "leaf", "salt")
    joined = found.join(proofs.select(F.col("doc_id").alias("d"), "proof"), F.col("doc_id") == F.col("d"), "left").select("doc_id", "salt", "leaf", "proof")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [p is not None and fold(leaf.hex().encode(), unpack_links(p)).decode() == root for leaf, p in zip(batch.column("leaf").to_pylist(), batch.column("proof").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("salt"), pa.array(ok, pa.bool_())], ["doc_id", "salt", "ok"])

    checked = joined.mapInArrow(run, "doc_id long, salt long, ok boolean")
    return checked.groupBy("doc_id", "salt").agg(F.max("ok").alias("verified")).drop("salt")


def op11_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    return manifest(common.table(spark, sf_dir, "documents"))


def _oracle(source_levels: int = 6, root_levels: int = 4) -> str:
    """The manifest of up to 16 ** source_levels rows a source and 16 ** root_levels sources."""
    told = lambda x: f"coalesce(strlen({x}) || ':' || {x}, '-')"
    signed = lambda text: "sha256(" + " || ".join(told(x) for x in ("CAST(CAST(doc_id AS BIGINT) AS VARCHAR)", "source", "lang", "CAST(CAST(n_chars AS BIGINT) AS VARCHAR)", text)) + ")"
    bit = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    crc = f"xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(k) + 1), lambda p: CAST(ascii(substr(k, p, 1)) AS BIGINT))), lambda c, b: {bit}), 4294967295)"
    steps = [f"""
d AS (SELECT row_number() OVER () AS r, doc_id, source, CAST(CAST(doc_id AS BIGINT) AS VARCHAR) AS k, {signed("text")} AS leaf, {signed(f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')")} AS bad FROM documents)
, t0 AS (
  SELECT r, doc_id, source, leaf, k IS NOT NULL AND coalesce({crc}, 1) % {TAMPER_EVERY} = 0 AS tampered, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n, bad FROM d
), f0 AS (SELECT r, g, i, i AS position, leaf AS own, CASE WHEN tampered THEN bad ELSE leaf END AS cur, '' AS proof FROM t0)
, n0 AS (SELECT g, i, n, leaf AS h FROM t0)"""]
    levels = source_levels + root_levels
    for k in range(levels):
        if k == source_levels:  # from here on the sources' roots are one group
            steps.append(f", s{k} AS (SELECT 0 AS g, g AS i, count(*) OVER () AS n, h FROM n{k}), e{k} AS (SELECT * REPLACE (0 AS g, g AS i) FROM f{k})")
        n, f = (f"s{k}", f"e{k}") if k == source_levels else (f"n{k}", f"f{k}")
        steps.append(f"""
, r{k} AS (SELECT g, i // {ARITY} AS i, (max(n) + {ARITY - 1}) // {ARITY} AS n, string_agg(h, '' ORDER BY i) AS run FROM {n} WHERE n > 1 GROUP BY g, i // {ARITY})
, n{k + 1} AS (SELECT g, i, n, sha256(run) AS h FROM r{k} UNION ALL SELECT g, i, n, h FROM {n} WHERE n = 1)
, f{k + 1} AS (
  SELECT f.r, f.g, CASE WHEN run IS NULL THEN f.i ELSE f.i // {ARITY} END AS i, position,
    CASE WHEN run IS NULL THEN own ELSE sha256(run[: (f.i % {ARITY}) * 64] || own || run[(f.i % {ARITY}) * 64 + 65 :]) END AS own,
    CASE WHEN run IS NULL THEN cur ELSE sha256(run[: (f.i % {ARITY}) * 64] || cur || run[(f.i % {ARITY}) * 64 + 65 :]) END AS cur,
    CASE WHEN run IS NULL THEN proof ELSE proof || run[: (f.i % {ARITY}) * 64] || run[(f.i % {ARITY}) * 64 + 65 :] END AS proof
  FROM {f} f LEFT JOIN r{k} r ON f.g = r.g AND f.i // {ARITY} = r.i
)""")
    return "WITH " + "".join(steps) + f"""
SELECT t.doc_id, t.leaf, b.own AS subroot, f.own AS root, sha256(f.proof) AS proof_sha256, f.cur AS folded_root, f.cur = f.own AS verified, t.tampered, t.source, f.position
FROM f{levels} f JOIN t0 t USING (r) JOIN f{source_levels} b USING (r)"""


OP11_SQL = _oracle()
