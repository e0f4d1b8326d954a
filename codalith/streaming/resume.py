"""Judging in steps that can be resumed: what an output table has is not done again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pending(observations: DataFrame, done: DataFrame, key: str = "id", retry_errors: bool = False) -> DataFrame:
    """Observations that done doesn't hold yet; failed ones count as done unless asked for."""
    if retry_errors and "error" in done.columns:
        done = done.where(F.col("error").isNull())
    return observations.join(done.select(key).distinct(), key, "left_anti")


def decide_stream(spark: SparkSession, source: str, schema, output: str, checkpoint: str, decide: Callable[[DataFrame], DataFrame], files_per_batch: int = 8):
    """Follows a folder of Parquet files: each micro-batch is decided and appended once; restarts go on at the checkpoint."""

    def write(batch: DataFrame, epoch: int) -> None:
        # A batch that is replayed after a crash replaces its own rows.
        decide(batch).withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{output}/epoch={epoch}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
