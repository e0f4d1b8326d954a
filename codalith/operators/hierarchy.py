"""Operators on code trees: pruning of linear chains, truncation of annotations, leaves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codalith.functions.codes import ancestors, depth, parent_code, truncate_code


def children_counts(codes: DataFrame) -> DataFrame:
    """code and n_children of a table of codes."""
    counted = codes.select(parent_code("code").alias("code")).where("code IS NOT NULL").groupBy("code").agg(F.count("*").alias("n_children"))
    return codes.join(counted, "code", "left").select("code", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"))


def prune_mapping(codes: DataFrame) -> DataFrame:
    """(code, code_parent_equivalent): codes with one child at most, mapped to the top of their chain of such codes.

    The top lies below the deepest ancestor that branches or is missing, so no recursion is needed.
    """
    linear = children_counts(codes).where("n_children <= 1").select("code")
    above = linear.select("code", F.explode(ancestors("code")).alias("above"))
    branching = above.join(linear.select(F.col("code").alias("above")), "above", "left_anti")
    deepest = branching.groupBy("code").agg(F.max(depth("above")).alias("d"))
    joined = linear.join(deepest, "code", "left")
    segments = F.split("code", "\\.")
    return joined.select("code", F.array_join(F.slice(segments, F.lit(1), F.coalesce("d", F.lit(0)) + 1), ".").alias("code_parent_equivalent"))


def truncate_and_prune(annotations: DataFrame, mapping: DataFrame, code: str = "code", level: int = 4) -> DataFrame:
    """annotations with code_final: truncated, then mapped, or as truncated where the mapping is silent."""
    cut = annotations.withColumn("code_cut", truncate_code(code, level))
    by = mapping.select(F.col("code").alias("code_cut"), "code_parent_equivalent")
    return cut.join(by, "code_cut", "left").withColumn("code_final", F.coalesce("code_parent_equivalent", "code_cut")).drop("code_parent_equivalent")


def leaves(codes: DataFrame) -> DataFrame:
    """Codes below which there is none."""
    inner = codes.select(F.explode(ancestors("code")).alias("code")).distinct()
    return codes.join(inner, "code", "left_anti")


def with_ancestors(codes: DataFrame) -> DataFrame:
    """Distinct codes and all their ancestors."""
    known = codes.where("code IS NOT NULL").select("code").distinct()
    return known.select(F.explode(F.concat(ancestors("code"), F.array("code"))).alias("code")).distinct()
