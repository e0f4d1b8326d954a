"""Evaluation in full: every average by scope, level and threshold, reports by slice, rates per code, totals of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codalith.functions.codes import at_level, is_technical
from codalith.operators.metrics import once, share

AVERAGES = ("weighted", "macro")


def _reach(value: str, limits: list[float]) -> Column:
    """How many of the sorted limits a value reaches, so that rows are counted by few values before they multiply."""
    return F.size(F.filter(F.array(*[F.lit(float(x)) for x in limits]), lambda x: F.coalesce(F.col(value) >= x, F.lit(False))))


def _passed(reach: str, limits: list[float]) -> Column:
    return F.explode(F.slice(F.array(*[F.lit(float(x)) for x in limits]), F.lit(1), F.col(reach))).alias("threshold")


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def _class_scores(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Per keys of pairs (keys, t, p, n): n, accuracy, and precision, recall and F1 by each average.

    A class that is never predicted, or never true, has precision or recall 0. Over all classes the micro
    averages of single labels are the accuracy itself.
    """
    zero = F.lit(0).cast("long")
    hits = F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(zero)
    sides = F.explode(F.array(
        F.struct(F.col("t").alias("class"), F.col("n").alias("support"), zero.alias("guessed"), hits.alias("hits")),
        F.struct(F.col("p").alias("class"), zero.alias("support"), F.col("n").alias("guessed"), zero.alias("hits")),
    )).alias("s")
    classes = pairs.select(*keys, sides).groupBy(*keys, "s.class").agg(*[F.sum(f"s.{c}").alias(c) for c in ("support", "guessed", "hits")])
    scored = classes.withColumns({"precision": _ratio(F.col("hits"), F.col("guessed")), "recall": _ratio(F.col("hits"), F.col("support")), "f1": _ratio(2 * F.col("hits"), F.col("support") + F.col("guessed"))})
    names = ("precision", "recall", "f1")
    weighted = [(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(f"weighted_{c}") for c in names]
    accuracy = (F.sum("hits") / F.sum("support")).alias("accuracy")
    return scored.groupBy(*keys).agg(F.sum("support").alias("n"), accuracy, *weighted, *[F.avg(c).alias(f"macro_{c}") for c in names])


def score_table(df: DataFrame, truth: str, predicted: str, confidence: str, levels: list[int], thresholds: list[float], scopes: dict[str, Column]) -> DataFrame:
    """Per scope, level and threshold: rows, their share of the scope, accuracy, and all averages; a row for each even where none is left.

    Rows with truth and prediction at the level count. The scopes are conditions, and a row may be in several.
    """
    inside = F.explode(F.array_compact(F.array(*[F.when(F.col(f"_in{n}"), F.lit(name)) for n, name in enumerate(scopes)]))).alias("scope")
    scoped = once(df, truth, predicted, confidence, *[c.alias(f"_in{n}") for n, c in enumerate(scopes.values())]).select(truth, predicted, confidence, inside)
    totals = scoped.groupBy("scope").agg(F.count("*").alias("total"))  # a row a scope
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), at_level(truth, k).alias("t"), at_level(predicted, k).alias("p")) for k in levels])).alias("x")
    limits = sorted(thresholds)
    rows = scoped.select("scope", _reach(confidence, limits).alias("reach"), cells).where("x.t IS NOT NULL AND x.p IS NOT NULL").groupBy("scope", "x.level", "x.t", "x.p", "reach").agg(F.count("*").alias("n"))
    pairs = rows.select("scope", "level", "t", "p", "n", _passed("reach", limits)).groupBy("scope", "level", "threshold", "t", "p").agg(F.sum("n").alias("n"))
    every = df.sparkSession.createDataFrame([(s, k, float(t)) for s in scopes for k in levels for t in thresholds], "scope string, level int, threshold double")
    out = every.join(_class_scores(pairs, ["scope", "level", "threshold"]), ["scope", "level", "threshold"], "left").join(F.broadcast(totals), "scope", "left")
    n = F.coalesce("n", F.lit(0)).cast("long")
    return out.withColumns({"n": n, "coverage": F.coalesce(n / F.col("total"), F.lit(0.0))}).drop("total")


def slice_report(df: DataFrame, truth: str, ranked: list[str], slices: dict[str, Column], levels: list[int], k: int) -> DataFrame:
    """Per slice and value: rows, top-1 accuracy, weighted F1, and the share of rows with the truth among the first 2 ... k.

    Slices are overall, every level (truth and predictions cut to it) and the given ones, whose null is N/A.
    Rows without truth or first prediction don't count.
    """
    whole = F.struct(F.col(truth).alias("t"), F.array(*ranked).alias("p"))
    named = [F.struct(F.lit("overall").alias("slice"), F.lit("").alias("value"), whole.alias("x"))]
    named += [F.struct(F.lit("level").alias("slice"), F.lit(str(n)).alias("value"), F.struct(at_level(truth, n).alias("t"), F.array(*[at_level(c, n) for c in ranked]).alias("p")).alias("x")) for n in levels]
    named += [F.struct(F.lit(name).alias("slice"), F.coalesce(f"_slice{n}", F.lit("N/A")).alias("value"), whole.alias("x")) for n, name in enumerate(slices)]
    rows = once(df, truth, *ranked, *[c.cast("string").alias(f"_slice{n}") for n, c in enumerate(slices.values())]).select(F.explode(F.array(*named)).alias("r")).select("r.slice", "r.value", F.col("r.x.t").alias("t"), F.col("r.x.p").alias("p")).where("t IS NOT NULL AND p[0] IS NOT NULL")
    hit = lambda n: F.count_if(F.coalesce(F.array_contains(F.slice("p", 1, n), F.col("t")), F.lit(False)))
    counted = rows.groupBy("slice", "value", "t", F.col("p")[0].alias("p1")).agg(F.count("*").alias("n"), *[hit(n).alias(f"h{n}") for n in range(2, k + 1)])
    scored = _class_scores(counted.select("slice", "value", "t", F.col("p1").alias("p"), "n"), ["slice", "value"]).select("slice", "value", "n", "accuracy", "weighted_f1")
    if k < 2:
        return scored
    top = counted.groupBy("slice", "value").agg(*[(F.sum(f"h{n}") / F.sum("n")).alias(f"top{n}") for n in range(2, k + 1)])
    return scored.join(top, ["slice", "value"])


def rate_by_code(df: DataFrame, code: str, ok: Column, length: int) -> DataFrame:
    """Per first length characters of a code: right rows (0 where there are none), all rows, and whole percent, halves to even."""
    hits = F.count_if(F.coalesce(ok, F.lit(False)))
    out = df.groupBy(F.substring(code, 1, length).alias("code")).agg(hits.alias("n_right"), F.count("*").alias("n"))
    return out.withColumn("percent_right", F.bround(100.0 * F.col("n_right") / F.col("n"), 0))


def contingency(df: DataFrame, ok: Column, value: str, thresholds: list[float]) -> DataFrame:
    """Per threshold how many rows are right, wrong and unknown; rows of null value stay at every threshold, as unknown."""
    limits = sorted(thresholds)
    reach = F.when(F.col(value).isNull(), len(limits)).otherwise(_reach(value, limits))
    judged = df.groupBy(F.when(F.col(value).isNotNull(), ok).alias("ok"), reach.alias("reach")).agg(F.count("*").alias("m")).select("ok", "m", _passed("reach", limits))
    counted = judged.groupBy("threshold", "ok").agg(F.sum("m").alias("n"))
    totals = counted.groupBy("threshold").agg(F.sum("n").alias("total"))  # a row a threshold
    return counted.join(F.broadcast(totals), "threshold")


def weighted_slices(df: DataFrame, ok: Column, weight: str, slices: dict[str, Column]) -> DataFrame:
    """Per slice and value (null is N/A): the weight, and the share of it that is right."""
    named = F.explode(F.array(*[F.struct(F.lit(n).alias("slice"), F.coalesce(c.cast("string"), F.lit("N/A")).alias("value")) for n, c in slices.items()])).alias("s")
    rows = df.select(F.coalesce(ok, F.lit(False)).alias("ok"), F.col(weight).alias("w"), named)
    return rows.groupBy("s.slice", "s.value").agg(F.sum("w").alias("weight"), (F.sum(F.when(F.col("ok"), F.col("w")).otherwise(0.0)) / F.sum("w")).alias("accuracy"))


def class_counts(df: DataFrame, code: str, levels: list[int]) -> DataFrame:
    """Per level the number of distinct classes, with the technical ones and without."""
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), at_level(code, k).alias("c")) for k in levels])).alias("x")
    rows = df.select(cells).select("x.*").where("c IS NOT NULL")
    return rows.groupBy("level").agg(F.count_distinct("c").alias("classes"), F.count_distinct(F.when(~is_technical("c"), F.col("c"))).alias("standard_classes"))


def rate_histogram(df: DataFrame, by: str, ok: Column, min_rows: int = 20, parts: int = 10) -> DataFrame:
    """How many groups of min_rows rows or more have an accuracy in each tenth (1 belongs to the last)."""
    rates = df.where(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("n"), share(F.coalesce(ok, F.lit(False))).alias("rate")).where(F.col("n") >= min_rows)
    step = F.least(F.floor(F.round(F.col("rate") * parts, 9)), F.lit(parts - 1)).cast("int")
    return rates.groupBy(step.alias("bin")).agg(F.count("*").alias("n_groups"), F.sum("n").alias("n_rows"))


def dimension_panel(df: DataFrame, truth: str, predicted: str, by: str, level: int, top: int = 20) -> DataFrame:
    """The top most frequent values of a dimension (null is N/A; ties by name): rows, rows at the level, classes, accuracy."""
    t, p = at_level(truth, level), at_level(predicted, level)
    counted = df.groupBy(F.coalesce(F.col(by).cast("string"), F.lit("N/A")).alias("value")).agg(F.count("*").alias("volume"), F.count(t).alias("n"), F.count_distinct(t).alias("classes"), share(F.when(t.isNotNull(), F.coalesce(t == p, F.lit(False)))).alias("accuracy"))
    return counted.orderBy(F.col("volume").desc(), "value").limit(top)


def error_figures(df: DataFrame, truth: str, predicted: str, confidence: str) -> DataFrame:
    """One row: rows, errors, mean confidence of all and of errors, distinct true codes of errors."""
    wrong = ~F.coalesce(F.col(truth) == F.col(predicted), F.lit(False))
    return df.agg(F.count("*").alias("n"), F.count_if(wrong).alias("n_errors"), F.avg(confidence).alias("mean_confidence"), F.avg(F.when(wrong, F.col(confidence))).alias("error_confidence"), F.count_distinct(F.when(wrong, F.col(truth))).alias("error_codes"))


def run_totals(df: DataFrame, error: str, prompt_tokens: str, completion_tokens: str, seconds: str) -> DataFrame:
    """One row about a run of a language model: answers, errors, tokens, seconds, and answers a minute of model time."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    out = df.agg(F.count("*").alias("n"), F.count(error).alias("n_errors"), total(prompt_tokens).alias("prompt_tokens"), total(completion_tokens).alias("completion_tokens"), total(seconds).alias("seconds"))
    return out.withColumns({"tokens": F.col("prompt_tokens") + F.col("completion_tokens"), "per_minute": F.when(F.col("seconds") > 0, 60 * F.col("n") / F.col("seconds")).otherwise(0.0)})
