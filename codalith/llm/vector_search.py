"""Exact top-k search by inner product with vector-approximation files.

Equal vectors are one node, with the k + 1 smallest vec_ids that have it: no others can be among k
results. A node that holds one vec_id alone is left out for the query of this id while cells are
scanned, so each node that is counted for a query has a row for it, however many rows share its id. Nodes are stored as cells of a few bits per component, in blocks, apart from the exact
vectors. Queries (a stated set, equal ones once) scan the cells alone: one product of a query with the
cells' middles, and one error per query and block, bound each score from both sides. A task carries
each query's best lower bounds from block to block, and the best of all tasks decide which nodes stay.
Exact vectors are then read by node, first those of the highest upper bounds; the k-th exact score
found says which others must be read too. The work is the number of queries times the number of rows.

Bounds are floats, widened by the error that rounding can make; exact scores are sums of integers, as
decimals where 64 bits might not hold them.

Defined results: vectors that are null or hold null, NaN or infinite components take no part, nor do
rows of null vec_id, nor vectors with a component of 2 ** 42 or more in size, whose scores are no
longs; scores beyond the range of long are ordered as they are and shown as its ends; vectors of
different length are not compared, and an empty vector scores 0; rows that share a query's vec_id are
its own; queries that share a vec_id count once, by the smallest vector; repeated candidate rows count
each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codalith.llm import common

K, SCALE, QUERY_EVERY = 10, 1024, 100
#: Bits of a cell, nodes in a block, queries in a block.
CELL_BITS, BLOCK_ROWS, QUERY_ROWS = 6, 4096, 256
#: Scaled components are smaller, so a sum of products has at most 38 digits.
LIMIT = float(1 << 52)

_BLOCK = pa.schema([("dim", pa.int32()), ("ids", pa.binary()), ("owners", pa.binary()), ("cells", pa.binary()), ("edges", pa.binary())])
_QUERY = pa.schema([("dim", pa.int32()), ("q_ids", pa.binary()), ("q_owners", pa.binary()), ("q_vectors", pa.binary())])


def _quantised(embeddings: DataFrame, scale: int) -> DataFrame:
    """(vec_id, dim, v): vectors that take part, as integers floor(scale * x)."""
    scaled = lambda x: F.floor(x.cast("double") * F.lit(float(scale)))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double") * F.lit(float(scale))) < F.lit(LIMIT)))
    usable = embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(F.coalesce(fine, F.lit(False)))
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), F.size("embedding").alias("dim"), F.transform("embedding", lambda x: scaled(x).cast("long")).alias("v"))


def cells_of(v: np.ndarray, bits: int = CELL_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Cell numbers and, per component, the lowest value and the width of a cell: the block's range cut in equal parts."""
    low, high = v.min(axis=0), v.max(axis=0)
    width = -(-(high - low + 1) // (1 << bits))
    return ((v - low) // width).astype(np.uint8), np.stack([low, width])


def bounds(q: np.ndarray, cells: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each query (a row of q) and each row of cells a score, and for each query the most that it is off by."""
    low, width = edges[0].astype(np.float64), edges[1].astype(np.float64)
    step = q * width  # of one cell
    base = q @ (low + (width - 1) / 2)
    inner = (step.astype(np.float32) @ cells.T.astype(np.float32)).astype(np.float64)
    # A float's last place, for each of dim products and sums and for what was rounded before.
    rounding = (len(low) + 8) * 2.0**-23 * (np.abs(step) @ np.full(len(low), float(int(cells.max(initial=0)) + 1)) + np.abs(q) @ np.abs(low + width))
    return inner + base[:, None], np.abs(q) @ ((width - 1) / 2) + rounding


def _rows(batch: pa.RecordBatch, id_column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, then of each row its id, its owner and whether it has one, the values and where each row's begin."""
    dims, owner = batch.column("dim").to_numpy(zero_copy_only=False), batch.column("owner")
    ids = (batch.column(id_column), owner.fill_null(0), owner.is_valid().cast(pa.int64()))
    return dims, np.stack([x.to_numpy(zero_copy_only=False) for x in ids], axis=1), batch.column("v").flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(dims)]


def _pack(rows: int, make, schema: pa.Schema, id_column: str):
    """Blocks of at most rows vectors of one length; make(ids, vectors) gives their binary columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, v = (np.concatenate(x) for x in zip(*held.pop(dim)))
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((dim, *make(ids, v)), schema)], schema=schema)

        for batch in batches:
            dims, ids, flat, begin = _rows(batch, id_column)
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                while len(own):
                    room = rows - sum(len(x) for x, _ in held.get(dim, []))
                    pick, own = own[:room], own[room:]
                    held.setdefault(dim, []).append((ids[pick].astype(np.int64), flat[begin[pick][:, None] + np.arange(dim)[None, :]].reshape(len(pick), dim).astype(np.int64)))
                    if len(pick) == room:
                        yield block(dim)
        for dim in list(held):
            yield block(dim)

    return run


def _data_block(ids: np.ndarray, v: np.ndarray) -> tuple[bytes, ...]:
    cells, edges = cells_of(v)
    return ids[:, 0].tobytes(), ids[:, 1:].tobytes(), cells.tobytes(), edges.tobytes()


def _query_block(ids: np.ndarray, v: np.ndarray) -> tuple[bytes, ...]:
    return ids[:, 0].tobytes(), ids[:, 1:].tobytes(), v.tobytes()


class Scan:
    """A block of queries on its way through blocks of cells: the best lower bounds, and what may be a result."""

    def __init__(self, ids: np.ndarray, owners: np.ndarray, q: np.ndarray, k: int):
        self.ids, self.owners, self.q, self.k = ids, owners, q, k
        self.best = np.full((len(q), k), -np.inf)  # each query's k best lower bounds, the k-th in front
        self.found: list[tuple[np.ndarray, ...]] = []

    def meet(self, ids: np.ndarray, owners: np.ndarray, cells: np.ndarray, edges: np.ndarray) -> None:
        score, off = bounds(self.q, cells, edges)
        score[(self.owners[:, None, 1] & owners[None, :, 1]).astype(bool) & (self.owners[:, None, 0] == owners[None, :, 0])] = -np.inf  # a query's own rows
        if len(ids) > self.k and not np.isfinite(self.best[:, 0]).all():
            top = np.partition(score, len(ids) - self.k, axis=1)[:, len(ids) - self.k :] - off[:, None]
            self.best = np.sort(np.c_[self.best, top], axis=1)[:, -self.k :]
            which, row = np.nonzero((score + off[:, None] >= self.best[:, :1]) & np.isfinite(score))
        else:
            which, row = np.nonzero((score + off[:, None] >= self.best[:, :1]) & np.isfinite(score))
            for n in np.unique(which).tolist():
                low = score[n, row[which == n]] - off[n]
                if low.max() > self.best[n, 0]:
                    self.best[n] = np.sort(np.r_[self.best[n], low])[-self.k :]
        self.found.append((which, ids[row], score[which, row], off[which]))

    def close(self) -> pa.RecordBatch:
        which, node, score, off = (np.concatenate(x) for x in zip(*self.found))
        near = score + off >= self.best[which, 0]
        which, node, score, off = which[near], node[near], score[near], off[near]
        return pa.RecordBatch.from_arrays([pa.array(self.ids[which]), pa.array(node), pa.array(score - off), pa.array(score + off)], ["unit", "node", "lower", "upper"])


def _meet(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, scan = None, None
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                if scan is None or row["q_ids"] != now:
                    if scan is not None:
                        yield scan.close()
                    now, q_ids = row["q_ids"], np.frombuffer(row["q_ids"], np.int64)
                    scan = Scan(q_ids, np.frombuffer(row["q_owners"], np.int64).reshape(-1, 2), np.frombuffer(row["q_vectors"], np.int64).reshape(len(q_ids), dim).astype(np.float64), k)
                ids = np.frombuffer(row["ids"], np.int64)
                scan.meet(ids, np.frombuffer(row["owners"], np.int64).reshape(-1, 2), np.frombuffer(row["cells"], np.uint8).reshape(len(ids), dim), np.frombuffer(row["edges"], np.int64).reshape(2, dim))
        if scan is not None:
            yield scan.close()
        common.trim()

    return run


def _product(a: str, b: str) -> Column:
    """The exact inner product of two arrays of long."""
    kind = "decimal(38,0)"
    largest = lambda c: F.coalesce(F.array_max(F.transform(c, lambda x: F.abs(x).cast("double"))), F.lit(0.0))
    short = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x).cast(kind)
    long = F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("decimal(19,0)") * y.cast("decimal(19,0)")).cast(kind)), F.lit(0).cast(kind), lambda s, x: (s + x).cast(kind))
    return F.when(largest(a) * largest(b) * F.size(a) < float(1 << 62), short).otherwise(long)


def top_k(embeddings: DataFrame, is_query, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of highest inner product for each row that is_query, a condition on vec_id, selects."""
    spark = embeddings.sparkSession
    common.small_batches(spark)
    rows = _quantised(embeddings, scale).groupBy("dim", "v", "vec_id").agg(F.least(F.count("*"), F.lit(k)).alias("times"))
    rows = common.stage_table(rows, "vectors")
    first = F.row_number().over(Window.partitionBy("dim", "v").orderBy("vec_id"))
    nodes = rows.withColumn("n", first).where(F.col("n") <= k + 1).groupBy("dim", "v").agg(F.collect_list(F.struct("vec_id", "times")).alias("members"))  # k + 1 at most
    nodes = nodes.withColumns({"node": F.monotonically_increasing_id(), "owner": F.when(F.size("members") == 1, F.col("members")[0]["vec_id"])})
    nodes = common.stage_table(nodes, "nodes")

    # Queries of one vector are a unit, unless rows of the query's id alone must be left out for it.
    chosen = rows.where(is_query).groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("q"), F.count("*").alias("vectors"))
    queries = chosen.select("vec_id", "vectors", F.col("q.dim").alias("dim"), F.col("q.v").alias("v")).join(nodes.select("dim", "v", "node", "owner"), ["dim", "v"])
    queries = common.stage_table(queries.select(F.col("vec_id").alias("query_id"), F.col("node").alias("u"), F.when((F.col("vectors") > 1) | F.col("owner").isNotNull(), F.col("vec_id")).alias("ask")), "queries")
    units = common.stage_table(queries.select("u", "ask").distinct().withColumn("unit", F.monotonically_increasing_id()), "units")

    # Each block of queries is dealt to all groups of data blocks, so that no task holds all of either side.
    groups = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-nodes.count() // BLOCK_ROWS)))
    data = nodes.select("node", "owner", "dim", "v").mapInArrow(_pack(BLOCK_ROWS, _data_block, _BLOCK, "node"), "dim int, ids binary, owners binary, cells binary, edges binary")
    data = data.withColumn("g", F.pmod(F.xxhash64("ids"), F.lit(groups)))
    vectors = units.join(nodes.select("node", "dim", "v"), F.col("node") == F.col("u")).select("unit", F.col("ask").alias("owner"), "dim", "v")
    asked = vectors.mapInArrow(_pack(QUERY_ROWS, _query_block, _QUERY, "unit"), "dim int, q_ids binary, q_owners binary, q_vectors binary")
    asked = asked.withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    # The merge join brings the blocks of data to a block of queries one after another.
    met = asked.join(data.hint("merge"), ["g", "dim"]).select("dim", "q_ids", "q_owners", "q_vectors", "ids", "owners", "cells", "edges")
    found = common.stage_table(met.mapInArrow(_meet(k), "unit long, node long, lower double, upper double"), "bounds")

    def kth(scores: DataFrame, column: str) -> DataFrame:
        """unit and the k-th largest value of column, or null where there are fewer."""
        ranked = scores.withColumn("n", F.row_number().over(Window.partitionBy("unit").orderBy(F.col(column).desc()))).where(F.col("n") <= k)
        return ranked.groupBy("unit").agg(F.when(F.count("*") == k, F.min(column)).alias("least"))

    def exact(pairs: DataFrame) -> DataFrame:
        asked = units.join(nodes.select(F.col("node").alias("own"), F.col("v").alias("q")), F.col("own") == F.col("u")).select("unit", "q", "ask")
        return pairs.join(nodes.select("node", "v", "members"), "node").join(asked, "unit").select("unit", "ask", "members", _product("v", "q").alias("score"))

    near = found.join(kth(found, "lower"), "unit").where("least IS NULL OR upper >= least").select("unit", "node", "upper")
    near = common.stage_table(near.withColumn("n", F.row_number().over(Window.partitionBy("unit").orderBy(F.col("upper").desc(), "node"))), "near")
    read = common.stage_table(exact(near.where(F.col("n") <= k)), "read")
    more = near.where(F.col("n") > k).join(kth(read, "score"), "unit").where("least IS NULL OR upper >= least")
    scored = read.union(exact(more)).select("unit", "ask", "score", F.explode("members").alias("m")).where("ask IS NULL OR m.vec_id <> ask").select("unit", "score", "m.vec_id", F.explode(F.array_repeat(F.lit(1), F.col("m.times").cast("int"))))
    # A unit without ask: each query has its own rows, k of them at most, in one node.
    ranked = scored.withColumn("n", F.row_number().over(Window.partitionBy("unit").orderBy(F.col("score").desc(), "vec_id"))).where(F.col("n") <= 2 * k)
    lists = ranked.groupBy("unit").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("r"))  # 2 * k rows at most
    mine = queries.withColumnsRenamed({"u": "v", "ask": "id"}).join(units, (F.col("v") == F.col("u")) & F.col("id").eqNullSafe(F.col("ask"))).join(lists, "unit").select("query_id", F.posexplode(F.slice(F.filter("r", lambda x: x["vec_id"] != F.col("query_id")), 1, k)).alias("at", "x"))
    shown = F.greatest(F.least(F.col("x.score"), F.lit(2**63 - 1).cast("decimal(38,0)")), F.lit(-(2**63)).cast("decimal(38,0)")).cast("long")
    return mine.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), shown.alias("score"))


def op4_exact_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % QUERY_EVERY == 0)


OP4_SQL = f"""
WITH vectors AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (SELECT vec_id, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i, len(v) AS dim FROM vectors)
, scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM (SELECT * FROM parts WHERE vec_id % {QUERY_EVERY} = 0) q JOIN parts c ON q.i = c.i AND q.dim = c.dim AND q.vec_id <> c.vec_id
  GROUP BY q.vec_id, c.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
) SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
