"""Parquet files whose footer and columns are encrypted with one key.

The format's own encryption (AES) is the Arrow library's. Each file has keys of its own, which travel in
it wrapped by the caller's key: XOR with an HMAC stream of a random number, and an HMAC over both.

A table is a folder of files and a list of them, which is written last; files of tasks that were lost
and run again are not in the list, so a reader never sees a row twice.
"""

from __future__ import annotations

import hashlib
import hmac
import json
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

LIST = "_files.json"


def _stream(key: bytes, nonce: bytes, n: int) -> bytes:
    return b"".join(hmac.digest(key, b"stream" + nonce + k.to_bytes(4, "big"), hashlib.sha256) for k in range(-(-n // 32)))[:n]


def wrap(key: bytes, data: bytes) -> bytes:
    nonce = os.urandom(16)
    body = nonce + bytes(a ^ b for a, b in zip(data, _stream(key, nonce, len(data))))
    return hmac.digest(key, b"tag" + body, hashlib.sha256) + body


def unwrap(key: bytes, data: bytes) -> bytes:
    tag, nonce, body = data[:32], data[32:48], data[48:]
    if not hmac.compare_digest(tag, hmac.digest(key, b"tag" + nonce + body, hashlib.sha256)):
        raise ValueError("the file was written with another key")
    return bytes(a ^ b for a, b in zip(body, _stream(key, nonce, len(body))))


def _properties(key: bytes):
    """The factory and settings that the Arrow library asks for."""
    import base64

    import pyarrow.parquet.encryption as encryption

    class Keys(encryption.KmsClient):
        def __init__(self, config):
            encryption.KmsClient.__init__(self)

        def wrap_key(self, key_bytes, master_key_identifier):
            return base64.b64encode(wrap(key, key_bytes)).decode()

        def unwrap_key(self, wrapped_key, master_key_identifier):
            return unwrap(key, base64.b64decode(wrapped_key))

    return encryption, encryption.CryptoFactory(Keys), encryption.KmsConnectionConfig()


def _file_system(path: str):
    from pyarrow.fs import FileSystem, LocalFileSystem

    return FileSystem.from_uri(path) if "://" in path else (LocalFileSystem(), os.path.abspath(path))


def write_encrypted(df: DataFrame, path: str, key: bytes) -> int:
    """Writes df to a new folder, which all executors must reach; the number of rows."""
    if len(key) < 16:
        raise ValueError("a key has 16 bytes or more")
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        encryption, factory, connection = _properties(key)
        settings = encryption.EncryptionConfiguration(footer_key="key", column_keys={"key": names}, double_wrapping=False)
        fs, base = _file_system(path)
        writer, file, rows = None, f"part-{uuid.uuid4().hex}.parquet", 0
        try:
            for batch in batches:
                if writer is None:
                    writer = pq.ParquetWriter(fs.open_output_stream(f"{base}/{file}"), batch.schema, encryption_properties=factory.file_encryption_properties(connection, settings))
                writer.write_batch(batch)
                rows += len(batch)
        finally:
            if writer is not None:
                writer.close()
        if writer is not None:
            yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([rows], pa.int64())], ["file", "rows"])

    fs, base = _file_system(path)
    fs.create_dir(base, recursive=True)
    written = df.mapInArrow(run, "file string, rows long").collect()  # a row a file
    with fs.open_output_stream(f"{base}/{LIST}") as out:
        out.write(json.dumps({"schema": df.schema.jsonValue(), "files": sorted(r["file"] for r in written)}).encode())
    return sum(r["rows"] for r in written)


def read_encrypted(spark: SparkSession, path: str, key: bytes, columns: list[str] | None = None) -> DataFrame:
    """The rows that write_encrypted wrote with this key; only the asked columns are read."""
    from pyspark.sql.types import StructType

    fs, base = _file_system(path)
    with fs.open_input_stream(f"{base}/{LIST}") as f:
        listed = json.loads(f.read())
    schema = StructType.fromJson(listed["schema"])
    chosen = StructType([schema[c] for c in columns]) if columns else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        _, factory, connection = _properties(key)
        own, folder = _file_system(path)
        for batch in batches:
            for file in batch.column("file").to_pylist():
                with own.open_input_file(f"{folder}/{file}") as source:
                    yield from pq.ParquetFile(source, decryption_properties=factory.file_decryption_properties(connection)).iter_batches(columns=chosen.names)

    files = [(f,) for f in listed["files"]]
    return spark.createDataFrame(files, "file string").repartition(max(1, len(files))).mapInArrow(run, chosen)
