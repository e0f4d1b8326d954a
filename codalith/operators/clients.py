"""Language models and other services over a table: concurrent, retried, in groups, resumable. The client is the caller's."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codalith.operators.selection import merged_results

POLICIES = ("raise", "none", "error")


class Refused(Exception):
    """What a client raises for a request that would fail again, so that it isn't retried."""


def asked(answer: Callable[[str], str], text: str, attempts: int, first_wait: float, longest_wait: float) -> str:
    """answer(text), after doubling waits where it raises anything but Refused; the last error if none succeeds."""
    for n in range(attempts):
        try:
            return answer(text)
        except Refused:
            raise
        except Exception:
            if n + 1 == attempts:
                raise
            time.sleep(min(longest_wait, first_wait * 2**n))
    raise ValueError("attempts must be 1 or more")


def answer_each(df: DataFrame, column: str, client: Callable[[], Callable[[str], str]], key: str = "id", concurrency: int = 8, attempts: int = 6, first_wait: float = 2.0, longest_wait: float = 60.0, policy: str = "error") -> DataFrame:
    """(key, answer, error, seconds): each text put to a client, concurrency at once in each task.

    client() is called once a task. With policy raise the first error ends the job, with none a failed
    text has neither answer nor error, with error it has its error. Results belong to keys.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy: {policy}")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        answer = client()

        def one(text: str | None) -> tuple[str | None, str | None, float]:
            began = time.perf_counter()
            try:
                found, error = (None if text is None else asked(answer, text, attempts, first_wait, longest_wait)), None
            except Exception as e:
                if policy == "raise":
                    raise
                found, error = None, f"{type(e).__name__}: {e}" if policy == "error" else None
            return found, error, time.perf_counter() - began

        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                rows = list(pool.map(one, [None if pd.isna(t) else t for t in batch["text"]]))
                yield pd.DataFrame({"key": batch["key"], "answer": [r[0] for r in rows], "error": [r[1] for r in rows], "seconds": [r[2] for r in rows]})

    rows = df.select(F.col(key).cast("string").alias("key"), F.col(column).cast("string").alias("text"))
    return rows.mapInPandas(run, "key string, answer string, error string, seconds double").withColumnRenamed("key", key)


def classify_groups(df: DataFrame, column: str, client: Callable[[], Callable[[list[str]], list[str | None]]], key: str = "id", size: int = 20) -> DataFrame:
    """(key, code, error): texts put to a client in groups of size; a group that fails, or has too few answers, is asked once more.

    Answers are aligned by place: missing ones are null, surplus ones are left out.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        answer = client()
        for batch in batches:
            for at in range(0, len(batch), size):
                part = batch.iloc[at : at + size]
                texts, found, error = part["text"].tolist(), [], None
                for _ in range(2):
                    try:
                        found, error = list(answer(texts)), None
                        if len(found) >= len(texts):
                            break
                    except Exception as e:
                        found, error = [], f"{type(e).__name__}: {e}"
                codes = (found + [None] * len(part))[: len(part)]
                yield pd.DataFrame({"key": part["key"].tolist(), "code": codes, "error": [error] * len(part)})

    rows = df.select(F.col(key).cast("string").alias("key"), F.col(column).cast("string").alias("text"))
    return rows.mapInPandas(run, "key string, code string, error string").withColumnRenamed("key", key)


def judge_with_checkpoint(inputs: DataFrame, path: str, judge: Callable[[DataFrame], DataFrame], key: str = "id", parts: int = 1) -> DataFrame:
    """inputs that were judged, with their results: what path holds already isn't judged again.

    The rest is judged in parts, each appended to the Parquet table at path before the next begins, so a
    run that ends early loses one part at most. judge gives key and its results; errors are results too.
    """
    spark = inputs.sparkSession

    def done() -> DataFrame | None:
        try:
            return spark.read.parquet(path)
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
                return None
            raise

    for n in range(parts):
        part = inputs.where(F.pmod(F.xxhash64(key), F.lit(parts)) == n)
        known = done()
        pending = part if known is None else part.join(known.select(key).distinct(), key, "left_anti")
        judge(pending).write.mode("append").parquet(path)
    return merged_results(inputs, done(), key)
