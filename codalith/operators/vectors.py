"""Exact cosine top-k of query vectors: blocks of queries meet blocks of vectors in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block of vectors or queries, and score cells that one step holds, at most.
BLOCK_ROWS, QUERY_ROWS, STEP_CELLS = 2_000, 500, 1 << 20


def _pack(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, ids = batch.column("embedding"), batch.column("vec_id").to_numpy(zero_copy_only=False)
            length = np.asarray(column.value_lengths(), np.int64)
            begin = np.cumsum(length) - length
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            for dim in np.unique(length).tolist():
                same = np.flatnonzero(length == dim)
                for at in range(0, len(same), rows):
                    pick = same[at : at + rows]
                    v = flat[begin[pick][:, None] + np.arange(dim)[None, :]]
                    v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-30)
                    yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([ids[pick].astype(np.int64).tobytes()], pa.binary()), pa.array([v.tobytes()], pa.binary())], ["dim", "ids", "v"])

    return run


def blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """dim, ids, v: packed unit vectors of equal length."""
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    return plain.mapInArrow(_pack(rows), "dim int, ids binary, v binary")


def best(ids: np.ndarray, q: np.ndarray, own: np.ndarray, v: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Query ids, vec_ids, scores and rounded scores of each query's first k vectors by rounded score and then vec_id, its own left out."""
    order = np.argsort(own, kind="stable")
    own, v = own[order], v[order]
    out: list[tuple[np.ndarray, ...]] = []
    step = max(1, STEP_CELLS // max(1, len(own)))
    for at in range(0, len(ids), step):
        score = q[at : at + step] @ v.T
        score[(ids[at : at + step, None] == own[None, :]) | ~np.isfinite(score)] = -np.inf
        rounded = np.round(score, 9)
        n = min(k, len(own))
        least = np.partition(rounded, len(own) - n, axis=1)[:, len(own) - n]
        above = rounded > least[:, None]
        equal = rounded == least[:, None]
        room = n - above.sum(axis=1)
        keep = above | (equal & (np.cumsum(equal, axis=1) <= room[:, None]))  # columns are in order of vec_id
        rows, columns = np.nonzero(keep & np.isfinite(score))
        out.append((ids[at : at + step][rows], own[columns], score[rows, columns], rounded[rows, columns]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _meet(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, *raw in zip(*(batch.column(c).to_pylist() for c in ("dim", "q_ids", "q", "ids", "v"))):
                ids, own = np.frombuffer(raw[0], np.int64), np.frombuffer(raw[2], np.int64)
                found = best(ids, np.frombuffer(raw[1]).reshape(len(ids), dim), own, np.frombuffer(raw[3]).reshape(len(own), dim), k)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["query_id", "vec_id", "score", "rounded"])

    return run


def cosine_top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score; each pair of blocks gives at most k rows per query before the merge."""
    # Each block of queries is dealt to all groups of blocks of vectors, so that no task holds all of either side.
    groups = max(1, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    data = blocks(vectors, BLOCK_ROWS).withColumn("g", F.pmod(F.xxhash64("ids"), F.lit(groups)))
    asked = blocks(queries, QUERY_ROWS).select("dim", F.col("ids").alias("q_ids"), F.col("v").alias("q"))
    asked = asked.withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    pairs = data.join(asked, ["g", "dim"]).select("dim", "q_ids", "q", "ids", "v")
    found = pairs.mapInArrow(_meet(k), "query_id long, vec_id long, score double, rounded double")
    order = Window.partitionBy("query_id").orderBy(F.col("rounded").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
