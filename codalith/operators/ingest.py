"""Ingest: budgets, duplicates, shop types, several sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sum_budget(df: DataFrame, keys: list[str], budget: str) -> DataFrame:
    """Budget (0 becomes null) and n_obs of each group; null keys are groups."""
    return df.groupBy(*keys).agg(F.nullif(F.sum(F.coalesce(budget, F.lit(0.0))), F.lit(0.0)).alias("budget"), F.count("*").alias("n_obs"))


def several_codes(df: DataFrame, key: str, code: str) -> DataFrame:
    """Rows whose key has more than one code."""
    many = df.groupBy(key).agg(F.count_distinct(code).alias("n_codes")).where("n_codes > 1")
    return df.join(many.select(key), key, "left_semi")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Groups of keys that stand in several rows, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def flag_duplicates(df: DataFrame, keys: list[str], name: str = "is_duplicate") -> DataFrame:
    """df with whether other rows have the same keys (null equals null): counts and a join, so that a hot key stays spread out."""
    counts = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count("*").alias("_n")).where("_n > 1")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return df.join(counts, same, "left").withColumn(name, F.col("_n").isNotNull()).select(*df.columns, name)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One whole row per keys, the first by order and then by all its columns: an aggregate, which combines before it shuffles."""
    rest = [c for c in df.columns if c not in order]
    least = F.min(F.struct(*order, *rest)).alias("r")
    return df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(least).select(*[F.col(f"r.{c}").alias(c) for c in df.columns])


def attach(df: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """Left join in which a null key matches a null key."""
    right = mapping.withColumnRenamed(key, "_key")
    return df.join(right, df[key].eqNullSafe(right["_key"]), "left").drop("_key")


def stack(parts: list[DataFrame]) -> DataFrame:
    """Rows of all parts by column name, missing columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def without_listed(df: DataFrame, key: str, listed: DataFrame) -> DataFrame:
    """Rows whose key isn't listed; null keys stay."""
    return df.join(listed.select(key).distinct(), key, "left_anti")


def multi_source(df: DataFrame, sources: list[str], logic: str, all_sources: list[str]) -> DataFrame:
    """Filter on boolean columns: any or all of sources, only those and no other, or none of them."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    every = reduce(lambda a, b: a & b, map(flag, sources))
    some = reduce(lambda a, b: a | b, map(flag, sources))
    rest = reduce(lambda a, b: a | b, [flag(c) for c in all_sources if c not in sources], F.lit(False))
    return df.where({"any": some, "all": every, "only": every & ~rest, "none": ~some}[logic])
