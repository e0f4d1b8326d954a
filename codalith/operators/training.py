"""Training sets: balancing, splits, class weights, support filters. Choices by a hash, so that any engine repeats them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(key: str, seed: int) -> Column:
    """A random-looking text of a row, the same wherever it is computed."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))


def balance(df: DataFrame, label: str, is_first: Column, key: str, cap: int, seed: int = 42) -> DataFrame:
    """Per label at most cap rows: those of the first source first, the rest filled up from the second."""
    order = Window.partitionBy(label).orderBy(F.when(F.col("_first"), 0).otherwise(1), "_draw", key)
    ranked = df.withColumns({"_first": F.coalesce(is_first, F.lit(False)), "_draw": draw(key, seed)}).withColumn("_rn", F.row_number().over(order))
    return ranked.where(F.col("_rn") <= cap).drop("_first", "_draw", "_rn")


def split(df: DataFrame, key: str, test_percent: int = 50, seed: int = 42) -> DataFrame:
    """df with part, test or train, without a shuffle."""
    number = F.conv(F.substring(draw(key, seed), 1, 8), 16, 10).cast("long") % 100
    return df.withColumn("part", F.when(number < test_percent, "test").otherwise("train"))


def stratified_split(df: DataFrame, label: str, key: str, test_percent: int = 20, seed: int = 42) -> DataFrame:
    """df with part; of each label's n rows ceil(n * test_percent / 100) are test rows, the first by their draw.

    A label's rows are ranked in 4096 slices of the draw, whose counts give each its first rank, so a
    label that most rows have isn't sorted in one task.
    """
    drawn = df.withColumn("_draw", draw(key, seed)).withColumn("_slice", F.substring("_draw", 1, 3))
    counted = drawn.groupBy(F.col(label).alias("_label"), "_slice").agg(F.count("*").alias("_n"))
    own = Window.partitionBy("_label")  # rows of slices
    placed = counted.select("_label", F.col("_slice").alias("_s"), (F.sum("_n").over(own.orderBy("_slice")) - F.col("_n")).alias("_before"), F.sum("_n").over(own).alias("_all"))
    ranked = drawn.join(placed, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_slice") == F.col("_s")))
    rank = F.col("_before") + F.row_number().over(Window.partitionBy(label, "_slice").orderBy("_draw", key))
    return ranked.withColumn("part", F.when(rank <= F.ceil(F.col("_all") * test_percent / 100), "test").otherwise("train")).select(*df.columns, "part")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Rows of all labels over (number of labels times rows of the label)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.sum("n").alias("total"), F.count("*").alias("classes"))  # one row
    return counts.join(F.broadcast(totals)).select(label, "n", (F.col("total") / (F.col("classes") * F.col("n"))).alias("weight"))


def supported(df: DataFrame, label: str, min_rows: int) -> DataFrame:
    """Rows whose label has min_rows rows or more: a count and a join, so that a hot label stays spread out."""
    large = df.groupBy(label).agg(F.count("*").alias("_n")).where(F.col("_n") >= min_rows).select(label)
    return df.join(large, label, "left_semi")
