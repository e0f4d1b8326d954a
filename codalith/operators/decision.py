"""Arbitration between predictions: consensus, judge answers, confidence along a cascade, beams and masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CONSENSUS_FROM = 0.90


def consensus(first, confidence, others: list, threshold: float = CONSENSUS_FROM) -> Column:
    """The first code where it is confident enough and no other known code differs; else null."""
    agree = F.lit(True)
    for other in others:
        agree = agree & F.coalesce(F.col(other) == F.col(first), F.lit(True))
    return F.when((F.col(confidence) >= threshold) & F.col(first).isNotNull() & agree, F.col(first))


def answer_json(response) -> Column:
    """The JSON object of an answer: fences stripped, else from the first to the last brace; null if neither parses."""
    text = F.trim(F.regexp_replace(response, "```(json)?", ""))
    inner = F.regexp_extract(text, "(?s)\\{.*\\}", 0)
    parses = lambda c: F.try_parse_json(c).isNotNull() & F.startswith(F.trim(c), F.lit("{"))
    return F.when(parses(text), text).when((F.length(inner) > 0) & parses(inner), inner)


def stopped_confidence(levels, threshold: float) -> Column:
    """Product of the confidences of an array of them, up to the first below threshold (that one left out)."""
    start = F.struct(F.lit(1.0).alias("product"), F.lit(0).alias("level"), F.lit(True).alias("on"))
    def step(state: Column, x: Column) -> Column:
        go = state["on"] & (x >= threshold)
        return F.struct(F.when(go, state["product"] * x).otherwise(state["product"]).alias("product"), F.when(go, state["level"] + 1).otherwise(state["level"]).alias("level"), go.alias("on"))
    return F.aggregate(levels, start, step)


def masked_argmax(scores: DataFrame, valid: DataFrame, row: str = "id") -> DataFrame:
    """Class of each row after its scores are masked to the children of its parent and made to sum to 1.

    scores: row, parent, class, p. valid: parent, class. Children without any mass share it evenly; a
    parent without children leaves the scores as they are.
    """
    known = valid.select("parent").distinct().withColumn("has_children", F.lit(True))
    flagged = scores.join(known, "parent", "left").join(valid.withColumn("ok", F.lit(True)), ["parent", "class"], "left")
    whole = Window.partitionBy(row)
    usable = F.col("ok").isNotNull() | F.col("has_children").isNull()
    kept = flagged.where(usable).withColumn("mass", F.sum("p").over(whole)).withColumn("n", F.count("*").over(whole))
    masked = kept.withColumn("q", F.when(F.col("mass") > 0, F.col("p") / F.col("mass")).otherwise(1 / F.col("n")))
    best = Window.partitionBy(row).orderBy(F.col("q").desc(), "class")
    return masked.withColumn("rn", F.row_number().over(best)).where("rn = 1").select(row, "class", "q")


def beam_step(beams: DataFrame, scores: DataFrame, width: int, row: str = "id") -> DataFrame:
    """beams (row, code, logp) grown by one level through scores (row, code, next, p), the width best kept."""
    grown = beams.join(scores, [row, "code"]).where("p > 0").select(row, F.col("next").alias("code"), (F.col("logp") + F.log("p")).alias("logp"))
    order = Window.partitionBy(row).orderBy(F.round("logp", 9).desc(), "code")
    return grown.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= width).drop("rn")
