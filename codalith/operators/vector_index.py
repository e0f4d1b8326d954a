"""A persisted inverted-file index of vectors: cells around centroids, residual codes, exact re-ranking of what is near.

Unit vectors are assigned to the nearest of some centroids, which are fitted on a bounded sample; the
index has a folder for each cell, with the vector's id, its residual to the centroid in a byte per
component, and the vector itself. A search reads the folders of the cells nearest to its queries alone
(partition pruning), scores codes there, and re-ranks the best of each query by exact cosine. Upserts
are assigned to the same centroids and written beside the others; of several vectors of one id the
latest counts. Every vector is indexed; a search that probes all cells and re-ranks all of them is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codalith.operators.vectors import cosine_top_k

#: Vectors that centroids are fitted on, at most, rounds of fitting, and queries that a search broadcasts at once.
SAMPLE_ROWS, ROUNDS, QUERY_ROWS = 20_000, 8, 2_000
#: Residual codes: one byte a component, of this range around a centroid.
CODE_RANGE = 2.0

_ROW = "vec_id long, version long, code binary, unit binary, cell int"


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-30)


def nearest(v: np.ndarray, centroids: np.ndarray, n: int = 1) -> np.ndarray:
    """The n nearest centroids of each unit vector, the nearest first; of equally near ones the first."""
    return np.argsort(-np.round(v @ centroids.T, 9), axis=1, kind="stable")[:, :n]


def fit_centroids(sample: np.ndarray, cells: int, seed: int = 42) -> np.ndarray:
    """Spherical k-means; a cell without vectors takes the one that is furthest from its own centroid."""
    cells = min(cells, len(np.unique(sample, axis=0)))
    centroids = np.unique(sample, axis=0)[np.random.default_rng(seed).permutation(len(np.unique(sample, axis=0)))[:cells]]
    for _ in range(ROUNDS):
        own = nearest(sample, centroids)[:, 0]
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        far = np.argsort((sample * centroids[own]).sum(axis=1), kind="stable")
        for k, lonely in enumerate(np.flatnonzero(np.bincount(own, minlength=cells) == 0).tolist()):
            sums[lonely] = sample[far[k]]
        centroids = unit(sums)
    return centroids


def encode(v: np.ndarray, centroids: np.ndarray, cell: np.ndarray) -> np.ndarray:
    return np.clip(np.round((v - centroids[cell]) * (127 / CODE_RANGE)), -127, 127).astype(np.int8)


def usable(vectors: DataFrame, dim: int | None = None) -> DataFrame:
    """(vec_id, v) of vectors that aren't null, hold finite numbers alone, have the length asked for and aren't zero."""
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return plain.where(F.coalesce(finite, F.lit(False)) & (F.size("v") == dim if dim else F.size("v") > 0))


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return unit(column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1))


@dataclass
class VectorIndex:
    path: str
    centroids: np.ndarray

    @staticmethod
    def build(vectors: DataFrame, path: str, cells: int = 64, seed: int = 42) -> VectorIndex:
        """Fits centroids on the SAMPLE_ROWS first vectors by a hash of their id and writes all vectors of the commonest length."""
        spark = vectors.sparkSession
        rows = usable(vectors)
        lengths = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
        rows = usable(vectors, lengths["dim"] if lengths else 1)
        sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("v").toArrow().column("v").combine_chunks()
        centroids = fit_centroids(_matrix(sample, len(sample)), cells, seed) if len(sample) else np.zeros((0, 1))
        spark.createDataFrame([(centroids.shape[1], bytearray(centroids.tobytes()))], "dim int, centroids binary").coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
        index = VectorIndex(path, centroids)
        index._write(rows, 0, "overwrite")
        return index

    @staticmethod
    def load(spark: SparkSession, path: str) -> VectorIndex:
        row = spark.read.parquet(f"{path}/centroids").first()
        return VectorIndex(path, np.frombuffer(bytes(row.centroids)).reshape(-1, row.dim))

    def _write(self, rows: DataFrame, version: int, mode: str) -> None:
        centroids = self.centroids

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.num_rows
                if not n:
                    continue
                v = _matrix(batch.column("v"), n)
                cell = nearest(v, centroids)[:, 0]
                raw = [pa.array([x.tobytes() for x in m], pa.binary()) for m in (encode(v, centroids, cell), v)]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(np.full(n, version)), *raw, pa.array(cell.astype(np.int32))], ["vec_id", "version", "code", "unit", "cell"])

        # cells of any size: a cell's vectors are dealt over several files
        coded = rows.mapInArrow(run, _ROW).repartition("cell", F.pmod(F.xxhash64("vec_id"), F.lit(8)))
        coded.write.mode(mode).partitionBy("cell").parquet(f"{self.path}/cells")

    def upsert(self, vectors: DataFrame) -> None:
        """Adds vectors, or new ones of known ids; of an id's vectors the last version counts, of one version's the largest."""
        spark = vectors.sparkSession
        version = spark.read.schema(_ROW).parquet(f"{self.path}/cells").agg(F.max("version")).first()[0]
        self._write(usable(vectors, self.centroids.shape[1]), 0 if version is None else version + 1, "append")

    def _latest(self, spark: SparkSession) -> DataFrame | None:
        """(vec_id, version) of ids that have been written again; None without upserts."""
        ids = spark.read.schema(_ROW).parquet(f"{self.path}/cells").select("vec_id", "version")
        return None if not ids.agg(F.max("version")).first()[0] else ids.groupBy("vec_id").agg(F.max("version").alias("last")).where("last > 0")

    def probes_for(self, queries: DataFrame, target: float = 0.92, k: int = 10) -> int:
        """How many cells a search must probe to find a share target of the k nearest, measured on queries against exact search.

        queries are a sample (SAMPLE_ROWS / 20 at most are used); vectors without clusters need most cells.
        """
        spark = queries.sparkSession
        some = queries.where("vec_id IS NOT NULL").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS // 20)
        rows = spark.read.schema(_ROW).parquet(f"{self.path}/cells")

        def doubles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = pa.array([np.frombuffer(x.as_buffer()) for x in batch.column("unit")], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), lists], ["vec_id", "embedding"])

        stored = rows.select("vec_id", "unit").mapInArrow(doubles, "vec_id long, embedding array<double>")
        exact = cosine_top_k(stored, usable(some, self.centroids.shape[1]).withColumnRenamed("v", "embedding"), k)
        cells = exact.join(rows.select("vec_id", "cell"), "vec_id").groupBy("query_id").agg(F.collect_list("cell").alias("cells"))
        met = usable(some, self.centroids.shape[1]).join(cells, F.col("query_id") == F.col("vec_id")).select("v", "cells").toArrow()  # a bounded sample
        if not met.num_rows:
            return len(self.centroids)
        order = nearest(_matrix(met.column("v").combine_chunks(), met.num_rows), self.centroids, len(self.centroids))
        place = np.argsort(order, axis=1)
        ranks = np.concatenate([place[k][np.array(c)] for k, c in enumerate(met.column("cells").to_pylist())])
        share = np.cumsum(np.bincount(ranks, minlength=len(self.centroids))) / len(ranks)
        return int(np.searchsorted(share, min(target, share[-1]))) + 1

    def search(self, queries: DataFrame, k: int = 10, probes: int = 8, refine: int = 10) -> DataFrame:
        """query_id, rank, vec_id, score: for each query the k best by exact cosine of the refine * k best by code, in its probes nearest cells.

        queries is (vec_id, embedding); a query doesn't find its own id. Blocks of QUERY_ROWS queries are a pass
        each. Ties by the smaller vec_id.
        """
        spark = queries.sparkSession
        asked = usable(queries, self.centroids.shape[1])
        asked = asked.groupBy("vec_id").agg(F.min("v").alias("v")).persist()
        n_blocks = max(1, -(-asked.count() // QUERY_ROWS))
        latest, found = self._latest(spark), None
        for block in range(n_blocks):
            part = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == block).toArrow()
            ids = part.column("vec_id").to_numpy()
            v = _matrix(part.column("v").combine_chunks(), len(ids)) if len(ids) else np.zeros((0, self.centroids.shape[1]))
            one = self._pass(spark, ids, v, latest, k, probes, refine)
            found = one if found is None else found.unionAll(one)
        asked.unpersist()
        ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("rounded"), "vec_id")))
        return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    def _pass(self, spark: SparkSession, ids: np.ndarray, v: np.ndarray, latest: DataFrame | None, k: int, probes: int, refine: int) -> DataFrame:
        """Exact scores of what codes choose; reads the folders that any of the queries probes."""
        cells = nearest(v, self.centroids, probes) if len(self.centroids) else np.zeros((len(v), 0), int)
        shared = spark.sparkContext.broadcast((ids, v, cells, self.centroids))
        rows = spark.read.schema(_ROW).parquet(f"{self.path}/cells").where(F.col("cell").isin(np.unique(cells).tolist()))
        if latest is not None:
            rows = rows.join(latest.withColumnRenamed("vec_id", "id"), F.col("id") == F.col("vec_id"), "left").where("last IS NULL OR version = last").drop("id", "last")
        rows = rows.select("vec_id", "code", "unit", "cell")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            query_ids, q, probed, centroids = shared.value
            for batch in batches:
                own = batch.column("vec_id").to_numpy()
                cell = batch.column("cell").to_numpy()
                for c in np.unique(cell).tolist():
                    at, who = np.flatnonzero(cell == c), np.flatnonzero((probed == c).any(axis=1))
                    codes = np.stack([np.frombuffer(batch.column("code")[i].as_buffer(), np.int8) for i in at.tolist()]).astype(np.float64)
                    exact = np.stack([np.frombuffer(batch.column("unit")[i].as_buffer()) for i in at.tolist()])
                    near = q[who] @ (centroids[c] + codes * (CODE_RANGE / 127)).T
                    near[query_ids[who][:, None] == own[at][None, :]] = -np.inf
                    keep = min(refine * k, len(at))
                    best = np.argpartition(-near, keep - 1, axis=1)[:, :keep]
                    rows_, columns = np.repeat(np.arange(len(who)), keep), best.ravel()
                    columns, rows_ = columns[np.isfinite(near[rows_, columns])], rows_[np.isfinite(near[rows_, columns])]
                    score = (q[who][rows_] * exact[columns]).sum(axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(query_ids[who][rows_]), pa.array(own[at][columns]), pa.array(score), pa.array(np.round(score, 9))], ["query_id", "vec_id", "score", "rounded"])

        scored = rows.mapInArrow(run, "query_id long, vec_id long, score double, rounded double")
        best = Window.partitionBy("query_id").orderBy(F.desc("rounded"), "vec_id")
        return scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"), F.max("rounded").alias("rounded")).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).drop("n")


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: the share of exact (query_id, vec_id) that found has."""
    hit = exact.select("query_id", "vec_id").join(found.select("query_id", "vec_id").withColumn("hit", F.lit(1)), ["query_id", "vec_id"], "left")
    return hit.agg(F.count("*").alias("n"), F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
