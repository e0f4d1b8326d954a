"""What several operators of this subpackage share: staged tables and Arrow text access."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import time
import uuid
import weakref
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a vectorised step handles at once; one longer document goes alone.
CHUNK_BYTES = 1 << 20
#: Most bytes and rows of an Arrow batch between the JVM and Python; long texts would make batches of any size otherwise.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 2000


_OWN_DIRS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a local session without one gets a folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    context = spark.sparkContext
    if context not in _OWN_DIRS:
        _OWN_DIRS[context] = tempfile.mkdtemp(prefix="codalith-stage-")
    return "file://" + _OWN_DIRS[context]


def stage_table(df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends here and lost executors cost nothing.

    All tables of an application are in one folder of its name, which may go when the application has ended.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/codalith-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.options(**{"compression": "zstd"} | (options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Deletes a table that stage_table wrote and nothing will read again."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files of finished phases; staged tables stay."""
    for _ in range(2):  # the first round frees what the second collects
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches, unless they are bounded more tightly already."""
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES), ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)):
        now = re.match(r"-?\d+", str(spark.conf.get(key)))
        if not now or not 0 < int(now[0]) <= most:
            spark.conf.set(key, str(most))


def trim() -> None:
    """Gives free memory of a Python worker back to the system, since workers stay for the next task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only what text operators need, so the scan reads two columns."""
    small_batches(spark)
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents with at most limit bytes together, or of one longer document."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, min(end, n)
        at = min(end, n)


def texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def filter_batches(docs: DataFrame, keeps) -> DataFrame:
    """The rows of docs, all columns, that keeps()(text column) marks; keeps() is called once a task."""

    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = keeps()
        for batch in batches:
            yield batch.filter(pa.array(marks(batch.column("text")), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
