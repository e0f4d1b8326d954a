"""Choosing rows, columns and values: recodes, overrides, samples, searches, look-ups, merges of results, spelling variants."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codalith.functions.codes import is_technical
from codalith.functions.text import fold_ascii
from codalith.operators.similarity import _grams, longest_common
from codalith.operators.training import draw

# Beginnings of shop types and the codes that they override, the first match wins.
RESTAURANTS = (
    ("Restauration professionnelle", "11.1.2"),
    ("Restauration rapide", "11.1.1.2"),
    ("Bars, cafés, salons de thé, glaciers", "11.1.1.2"),
    ("Restauration classique", "11.1.1.1"),
)


def useful_columns(columns: list[str]) -> list[str]:
    """Without English columns and those that a spreadsheet made up."""
    return [c for c in columns if "column" not in c.lower() and not c.endswith("_en")]


def recoded(column: str, mapping: dict[str, str]) -> Column:
    """Values of column by mapping; others stay."""
    return F.coalesce(reduce(lambda c, x: c.when(F.col(column) == x[0], F.lit(x[1])), mapping.items(), F.when(F.lit(False), F.lit(None))), F.col(column)) if mapping else F.col(column)


def restaurant_code(shop_type: str, code: str) -> Column:
    """The code of a restaurant's kind where the shop type names one, else code."""
    chosen = reduce(lambda c, x: c.when(F.contains(F.col(shop_type), F.lit(x[0])), F.lit(x[1])), RESTAURANTS, F.when(F.lit(False), F.lit(None).cast("string")))
    return chosen.otherwise(F.col(code))


def one_row(df: DataFrame, key: str, value) -> dict:
    """The first row with this key, as a dict; KeyError without one."""
    found = df.where(F.col(key) == value).limit(1).collect()
    if not found:
        raise KeyError(value)
    return found[0].asDict()


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows that look drawn at random and are the same wherever they are drawn."""
    return df.withColumn("_draw", draw(key, seed)).orderBy("_draw", key).limit(n).drop("_draw")


def tricky_errors(df: DataFrame, truth: str, predicted: str, codable: str, key: str, n: int, level: Column | None = None, seed: int = 42) -> DataFrame:
    """A sample of codable rows of standard codes whose prediction is wrong."""
    wrong = ~F.coalesce(F.col(predicted) == F.col(truth), F.lit(False)) if level is None else ~level
    return sample_rows(df.where(wrong & F.col(codable) & F.col(truth).isNotNull() & ~is_technical(truth)), key, n, seed)


def known_labels(df: DataFrame, label: str, known: DataFrame) -> DataFrame:
    """Rows whose label a model knows."""
    return df.join(known.select(F.col("label").alias(label)).distinct(), label, "left_semi")


def search(df: DataFrame, column: str, words: str, confidence: str, key: str, limit: int = 500) -> DataFrame:
    """The surest rows whose text holds words, in any case; ties by key. % and _ are ordinary characters."""
    return df.where(F.contains(F.lower(column), F.lit(words.lower()))).orderBy(F.col(confidence).desc_nulls_last(), key).limit(limit)


def first_groups(df: DataFrame, by: str, n: int) -> DataFrame:
    """The rows of the first n values of by, in order."""
    chosen = df.select(by).where(F.col(by).isNotNull()).distinct().orderBy(by).limit(n)
    return df.join(F.broadcast(chosen), by, "left_semi")  # n values


def merged_results(inputs: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """The inputs that have results, with them: the results' side decides, inputs of none are left out."""
    own = [c for c in inputs.columns if c == key or c not in results.columns]
    return inputs.select(own).join(results, key, "right")


def confidence_bucket(confidence) -> Column:
    """0 ... 9."""
    return F.least(F.greatest(F.floor(F.col(confidence) * 10 if isinstance(confidence, str) else confidence * 10), F.lit(0)), F.lit(9)).cast("int")


def estimated_tokens(text: str) -> Column:
    return F.floor(F.length(text) / 4).cast("int")


def iso_utc(at: str) -> Column:
    """A time as ISO 8601 in UTC, whatever the session's zone (at counts as session time)."""
    return F.concat(F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def date_stamp(at: str) -> Column:
    return F.date_format(at, "yyyyMMdd")


def label_numbers(df: DataFrame, label: str) -> DataFrame:
    """(label, number) of all labels in order, from 0. Labels are classes, a bounded list, so one window numbers them."""
    names = df.select(F.col(label).alias("label")).where("label IS NOT NULL").distinct()
    return names.withColumn("number", F.row_number().over(Window.orderBy("label")) - 1)


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = list(zip(batch.column("s1").to_pylist(), batch.column("s2").to_pylist()))
        found = [a[i : i + n] for a, b in pairs for i, n in [longest_common(a, b)]]
        yield pa.RecordBatch.from_arrays([batch.column("s1"), batch.column("s2"), pa.array(found, pa.string())], ["s1", "s2", "common_substring"])


def spelling_variants(names: DataFrame, column: str, at_least: int = 3) -> DataFrame:
    """Pairs of different names, shown trimmed and in ASCII, with their longest common substring of at_least characters.

    Names meet by their runs of at_least characters, so no pair that shares one is missed and no other is
    made. Names that differ in accents alone are a pair of equal texts.
    """
    plain = names.select(F.col(column).alias("raw")).distinct().withColumn("s", F.trim(fold_ascii(F.col("raw")))).where(F.length("s") >= at_least)
    runs = lambda n: plain.select(F.col("raw").alias(f"raw{n}"), F.col("s").alias(f"s{n}")).select("*", _grams(f"s{n}", F.array(F.lit(at_least))).alias("run"))
    pairs = runs(1).join(runs(2), "run").where("raw1 <> raw2").select("s1", "s2").distinct()
    return pairs.mapInArrow(_common, "s1 string, s2 string, common_substring string")
