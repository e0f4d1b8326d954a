"""Shapes of predictions: nested to wide and back, columns found by name, label look-ups, evaluation frames, answers checked."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codalith.functions.codes import level_plain, truncate_code

_RANKED = re.compile(r"^predicted_level(\d+)(?:_top(\d+))?$")


def wide_predictions(df: DataFrame, nested: str, levels: list[int], top_k: int = 1) -> DataFrame:
    """predicted_levelN and confidence_levelN of nested, a map from levelN to an array of (code, confidence), and _topK columns.

    Where a rank is missing the code is an empty text and the confidence 0.
    """
    out = {}
    for k in levels:
        ranked = F.col(nested)[f"level{k}"]
        for rank in range(1, top_k + 1):
            end = "" if rank == 1 else f"_top{rank}"
            at = F.try_element_at(ranked, F.lit(rank))
            out[f"predicted_level{k}{end}"] = F.coalesce(at["code"], F.lit(""))
            out[f"confidence_level{k}{end}"] = F.coalesce(at["confidence"], F.lit(0.0))
    return df.withColumns(out).drop(nested)


def ranked_columns(columns: list[str]) -> dict[int, list[str]]:
    """Prediction columns of each level found by their names, the first rank first."""
    found: dict[int, dict[int, str]] = {}
    for c in columns:
        if m := _RANKED.match(c):
            found.setdefault(int(m[1]), {})[int(m[2] or 1)] = c
    return {level: [ranks[r] for r in sorted(ranks)] for level, ranks in sorted(found.items())}


def with_level_columns(df: DataFrame, code: str, name: str = "level", last: int = 5) -> DataFrame:
    """df with name1 ... of code, as far as it lacks them."""
    return df.withColumns({f"{name}{k}": level_plain(code, k) for k in range(1, last + 1) if f"{name}{k}" not in df.columns})


def with_label(df: DataFrame, labels: DataFrame, code: str, out: str, default_to_code: bool = True) -> DataFrame:
    """df with the label of a code; unknown codes get themselves, or an empty text."""
    names = labels.select(F.col("code").alias(code), F.col("label").alias(out)).dropDuplicates([code])
    other = F.col(code) if default_to_code else F.lit("")
    return df.join(names, code, "left").withColumn(out, F.coalesce(out, other))


def evaluation_frame(predictions: DataFrame, annotations: DataFrame, mapping: DataFrame, level: int = 4, key: str = "id") -> DataFrame:
    """predictions joined to annotations, whose columns win, with code_cut, predicted_cut and retrieved_cut: truncated, then pruned.

    mapping (code, code_parent_equivalent) is a nomenclature's and so bounded; it goes into one map of maps,
    by first level, as a look-up in a map reads its keys one by one.
    """
    own = [c for c in predictions.columns if c == key or c not in annotations.columns]
    both = predictions.select(own).join(annotations, key)
    first = lambda c: F.substring_index(c, ".", 1)
    inner = mapping.groupBy(first(F.col("code")).alias("first")).agg(F.map_from_entries(F.collect_list(F.struct("code", "code_parent_equivalent"))).alias("own"))
    pruned = inner.agg(F.map_from_entries(F.collect_list(F.struct("first", "own"))).alias("_map"))  # one row
    found = lambda c: F.coalesce(F.try_element_at(F.try_element_at(F.col("_map"), first(c)), c), c)
    final = lambda c: found(truncate_code(c, level))
    return both.join(F.broadcast(pruned)).withColumns({"code_cut": final(F.col("code")), "predicted_cut": final(F.col("predicted")), "retrieved_cut": F.transform("retrieved", final)}).drop("_map")


def routed_code(variety: str, family_code: str, prefix: str = "99") -> Column:
    """The family's code where a variety begins with prefix and the family has one, else the variety."""
    return F.when(F.startswith(F.col(variety), F.lit(prefix)), F.coalesce(family_code, variety)).otherwise(F.col(variety))


DECISION = "code string, confiance int, codable boolean, justification string"
LONGEST_REASON = 500


def checked_decision(json: Column) -> Column:
    """(decision, error): the parsed answer, or why it can't be used; never both."""
    parsed = F.from_json(json, DECISION)
    error = (
        F.when(json.isNull() | F.try_parse_json(json).isNull(), "not JSON")
        .when(parsed["code"].isNull() | (F.length(F.trim(parsed["code"])) == 0), "no code")
        .when(parsed["confiance"].isNull(), "no confidence")
        .when(~parsed["confiance"].between(1, 5), "confidence outside 1 to 5")
        .when(F.length(parsed["justification"]) > LONGEST_REASON, "reason too long")
    )
    return F.struct(F.when(error.isNull(), parsed).alias("decision"), error.alias("error"))


def code_kind(code: str) -> Column:
    """standard, or the technical kind (98 or 99) whose prompt a category needs."""
    first = truncate_code(code, 1)
    return F.when(first.isin("98", "99"), first).when(first.isNotNull(), "standard")


def map_with_client(df: DataFrame, column: str, client: Callable[[], Callable[[list[str]], list[str]]], key: str = "id", size: int = 20, attempts: int = 3) -> DataFrame:
    """(key, answer, error): texts of column put to a client in groups of size, with retries.

    client() is called once a task and gives the function that answers a list of texts; an answer list
    of another length is an error. A failing group gets its last error and null answers, and doesn't
    stop the others. Results belong to keys, not to positions. Waiting between attempts is the client's.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        answer = client()
        for batch in batches:
            for at in range(0, len(batch), size):
                part = batch.iloc[at : at + size]
                texts, found, error = part["text"].tolist(), None, None
                for _ in range(attempts):
                    try:
                        found = answer(texts)
                        if len(found) != len(texts):
                            raise ValueError(f"{len(found)} answers to {len(texts)} texts")
                        error = None
                        break
                    except Exception as e:  # whatever a client raises becomes the rows' error
                        found, error = None, f"{type(e).__name__}: {e}"
                yield pd.DataFrame({"key": part["key"].tolist(), "answer": found or [None] * len(part), "error": [error] * len(part)})

    rows = df.select(F.col(key).cast("string").alias("key"), F.col(column).cast("string").alias("text"))
    return rows.mapInPandas(run, "key string, answer string, error string").withColumnRenamed("key", key)
