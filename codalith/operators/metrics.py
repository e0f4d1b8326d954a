"""Accuracy, top-k, calibration, coverage and confusion reports. The accuracies differ on purpose; see each docstring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codalith.functions.codes import at_level, level_result, truncate_code


def _levels(df: DataFrame, levels: list[int], make) -> DataFrame:
    """df once for each level, with what make(level) gives as columns: one scan, one shuffle later."""
    rows = F.array(*[F.struct(F.lit(k).alias("level"), *[c.alias(n) for n, c in make(k).items()]) for k in levels])
    return df.withColumn("_at", F.explode(rows)).select(*df.columns, "_at.*")


def once(df: DataFrame, *columns: str | Column) -> DataFrame:
    """These columns of df, each computed once a row, however often later expressions ask for them.

    explode of one element is where the optimizer stops to write a column's expression out in its place;
    with a look-up per level and rank such expressions grow past what can be compiled.
    """
    names = dict.fromkeys(c for c in columns if isinstance(c, str))
    return df.select(F.explode(F.array(F.struct(*names, *[c for c in columns if not isinstance(c, str)]))).alias("_once")).select("_once.*")


def share(condition: Column) -> Column:
    return F.avg(condition.cast("double"))


def report_accuracy(df: DataFrame, truth: str, methods: list[str], levels: list[int]) -> DataFrame:
    """Per method and level: rows whose truth reaches the level, right ones, accuracy. Shallower predictions are wrong."""
    long = once(df, truth, *methods).select(truth, F.explode(F.array(*[F.struct(F.lit(m).alias("method"), F.col(m).alias("predicted")) for m in methods])).alias("m")).select(truth, "m.*")
    each = _levels(long, levels, lambda k: {"ok": level_result(truth, "predicted", k)}).where("ok IS NOT NULL")
    return each.groupBy("method", "level").agg(F.count("*").alias("n"), F.count_if("ok").alias("n_ok"), share(F.col("ok")).alias("accuracy"))


def grouped_accuracy(df: DataFrame, truth: str, predicted: str, by: str, level: int, min_rows: int = 30) -> DataFrame:
    """Report accuracy by a column (null is a group), groups of min_rows applicable rows or more."""
    judged = df.withColumn("ok", level_result(truth, predicted, level)).where("ok IS NOT NULL")
    return judged.groupBy(by).agg(F.count("*").alias("n"), share(F.col("ok")).alias("accuracy")).where(F.col("n") >= min_rows)


def retrieval_accuracy(df: DataFrame, label: str, predicted: str, retrieved: str, levels: list[int], filters: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """Per filter and level: accuracy, retrieval accuracy, and accuracy of those rows whose label was retrieved.

    Codes are truncated, shallower ones compared as they are, and a null prediction of a null label is right.
    """
    marks = F.array_compact(F.array(*[F.when(c, name) for name, c in filters.items()])).alias("_filters")
    passing = once(df, label, predicted, retrieved, *(by or []), marks).withColumn("filter", F.explode("_filters"))
    def make(k: int) -> dict[str, Column]:
        t = truncate_code(label, k)
        return {"ok": truncate_code(predicted, k).eqNullSafe(t), "found": F.coalesce(F.exists(retrieved, lambda c: truncate_code(c, k) == t), F.lit(False))}
    each = _levels(passing, levels, make)
    return each.groupBy(*(by or []), "filter", "level").agg(F.count("*").alias("n"), share(F.col("ok")).alias("accuracy"), share(F.col("found")).alias("retrieval_accuracy"), F.coalesce(share(F.when(F.col("found"), F.col("ok"))), F.lit(0.0)).alias("generation_accuracy"))


def top_k_accuracy(df: DataFrame, truth: str, ranked: list[str], levels: list[int], ks: list[int], by: list[str] | None = None) -> DataFrame:
    """Per level and k: share of rows with the truth among the first k. Rows without truth or first prediction at the level don't count."""
    each = _levels(once(df, truth, *ranked, *(by or [])), levels, lambda k: {"t": at_level(truth, k), "p": F.array(*[at_level(c, k) for c in ranked])}).where("t IS NOT NULL AND p[0] IS NOT NULL")
    hit = lambda k: share(F.coalesce(F.exists(F.slice("p", 1, k), lambda x: x.eqNullSafe(F.col("t"))), F.lit(False)))
    wide = each.groupBy(*(by or []), "level").agg(F.count("*").alias("n"), *[hit(k).alias(f"_k{k}") for k in ks])
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"_k{k}").alias("accuracy")) for k in ks])).alias("x")
    return wide.select(*(by or []), "level", "n", rows).select(*(by or []), "level", "n", "x.*")


def class_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Per class: support, precision, recall and F1, 0 where undefined. Rows without truth or prediction don't count."""
    pairs = df.where(F.col(truth).isNotNull() & F.col(predicted).isNotNull()).groupBy(F.col(truth).alias("t"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("t").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("guessed"), F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0).alias("hits")),
        F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("guessed"), F.lit(0).cast("long").alias("hits")),
    )).alias("x")).select("x.*")
    summed = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "guessed", "hits")])
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    both = summed.withColumns({"precision": ratio(F.col("hits"), F.col("guessed")), "recall": ratio(F.col("hits"), F.col("support"))})
    total = F.col("precision") + F.col("recall")
    return both.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), total)).drop("hits")


def averaged_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Macro and weighted averages of class_report, and accuracy."""
    known = class_report(df, truth, predicted)
    out = known.agg(
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
        *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")],
        F.sum("support").alias("n"),
    )
    return out.withColumn("accuracy", F.col("weighted_recall"))


def thresholds_reached(confidence: str, n: int, steps: int) -> Column:
    """How many of the thresholds 0, 1/steps ... (n - 1)/steps a confidence reaches; 0 if it is null."""
    limits = F.array(*[F.lit(k / steps) for k in range(n)])
    return F.size(F.filter(limits, lambda t: F.coalesce(F.col(confidence) >= t, F.lit(False))))


def threshold_curve(df: DataFrame, confidence: str, ok: Column, steps: int = 20) -> DataFrame:
    """Coverage, and accuracy (0 if nothing is covered), at thresholds 0, 1/steps ... 1, from one pass over df."""
    rows = df.select(F.col(confidence).alias("c"), ok.alias("ok")).where("ok IS NOT NULL")
    at = F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("i")
    by_reach = rows.groupBy(thresholds_reached("c", steps + 1, steps).alias("reach")).agg(F.count("*").alias("n"), F.count_if("ok").alias("n_ok"))
    each = by_reach.select("reach", "n", "n_ok", at).withColumn("threshold", F.col("i") / steps)
    above = F.col("i") < F.col("reach")
    out = each.groupBy("threshold").agg(F.sum("n").alias("total"), F.sum(F.when(above, F.col("n")).otherwise(0)).alias("covered"), F.sum(F.when(above, F.col("n_ok")).otherwise(0)).alias("right"))
    return out.select("threshold", (F.col("covered") / F.col("total")).alias("coverage"), F.when(F.col("covered") > 0, F.col("right") / F.col("covered")).otherwise(0.0).alias("accuracy"))


def confusion_pairs(df: DataFrame, truth: str, predicted: str, limit: int = 20) -> DataFrame:
    """The most frequent wrong pairs, with their share of all errors; ties by name."""
    wrong = df.where(F.col(truth) != F.col(predicted)).groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))
    total = wrong.agg(F.sum("n").alias("total"))  # one row
    return wrong.join(F.broadcast(total)).withColumn("share", F.col("n") / F.col("total")).drop("total").orderBy(F.col("n").desc(), "truth", "predicted").limit(limit)


def confusion_matrix(df: DataFrame, truth: str, predicted: str, classes: list[str]) -> DataFrame:
    """Row shares of predicted classes; the classes are given, so nothing is collected to find them."""
    counts = df.where(F.col(truth).isNotNull() & F.col(predicted).isNotNull()).groupBy(F.col(truth).alias("truth"))
    return counts.agg(*[share(F.col(predicted) == c).alias(f"to_{c}") for c in classes])


def decile_bins(df: DataFrame, value: str, parts: int = 10) -> DataFrame:
    """df with bin, the number of the right-closed quantile interval of value (the lowest edge included); equal edges merge."""
    found = quantiles(df, value, [k / parts for k in range(parts + 1)]).get(None, [])
    edges = F.array(*[F.lit(e) for e in dict.fromkeys(found)]) if found else F.array().cast("array<double>")
    number = F.greatest(F.size(F.filter(edges, lambda e: e < F.col(value))), F.lit(1))
    return df.withColumn("bin", F.when(F.col(value).isNotNull(), number))


def quantiles(df: DataFrame, value: str, shares: list[float], by: Column | None = None, cells: int = 1024) -> dict:
    """Exact quantiles of the finite values of value, between neighbours in proportion, for each group that by names (few, as they come to the driver).

    No buffer holds the values: each pass counts them in cells between two bounds per asked rank, and the
    next pass looks into the one cell that the rank lies in, until it holds a single value.
    """
    rows = df.select((F.lit(None).cast("string") if by is None else by).alias("g"), F.col(value).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('infinity')")
    whole = {r["g"]: (r["n"], r["low"], r["high"]) for r in rows.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()}
    ranks = {g: sorted({k for q in shares for k in (int((n - 1) * q), min(int((n - 1) * q) + 1, n - 1))}) for g, (n, _, _) in whole.items()}
    #: Of each group and rank: the bounds that it lies in, and how many values lie below them.
    open_ = {(g, k): (whole[g][1], whole[g][2], 0) for g in whole for k in ranks[g]}
    known: dict[tuple, float] = {}
    while open_:
        for key in [k for k, (low, high, _) in open_.items() if low == high]:
            known[key] = open_.pop(key)[0]
        spans = sorted({(g, low, high) for (g, _), (low, high, _) in open_.items()}, key=str)
        if not spans:
            break
        at = rows.sparkSession.createDataFrame(spans, "g string, low double, high double")  # a row per open rank
        cell = F.least(F.floor((F.col("v") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2) * cells), F.lit(cells - 1))
        inside = rows.withColumnRenamed("g", "_g").join(F.broadcast(at), F.col("_g").eqNullSafe(F.col("g")) & F.col("v").between(F.col("low"), F.col("high")))
        counted: dict[tuple, list] = {}
        for r in inside.groupBy("g", "low", "high", cell.alias("cell")).agg(F.count("*").alias("n"), F.min("v").alias("first"), F.max("v").alias("last")).orderBy("cell").collect():
            counted.setdefault((r["g"], r["low"], r["high"]), []).append(r)
        for (g, k), (low, high, below) in list(open_.items()):
            for r in counted[g, low, high]:
                if k < below + r["n"]:
                    open_[g, k] = (r["first"], r["last"], below)
                    break
                below += r["n"]

    def between(g, q: float) -> float:
        place = (whole[g][0] - 1) * q
        low, high = known[g, int(place)], known[g, min(int(place) + 1, whole[g][0] - 1)]
        return low if low == high else (int(place) + 1 - place) * low + (place - int(place)) * high

    return {g: [between(g, q) for q in shares] for g in whole}


def agreement(df: DataFrame, truth: str, final: str, sources: list[str], level: int = 4) -> DataFrame:
    """By how the sources agree among themselves: rows, accuracy of final, share with a right source."""
    keyed = df.select(at_level(truth, level).alias("t"), at_level(final, level).alias("p"), F.array_compact(F.array(*[at_level(c, level) for c in sources])).alias("v")).where("t IS NOT NULL AND p IS NOT NULL")
    n, distinct = F.size("v"), F.size(F.array_distinct("v"))
    bucket = F.when(n < 2, "missing").when((distinct == 1) & (n == 3), "3 of 3").when((distinct == 1) & (n == 2), "2 of 2").when((distinct == 2) & (n == 3), "2 of 3").otherwise("none")
    return keyed.withColumn("bucket", bucket).groupBy("bucket").agg(F.count("*").alias("n"), share(F.col("p") == F.col("t")).alias("accuracy"), share(F.array_contains("v", F.col("t"))).alias("one_right"))


def cascade_errors(df: DataFrame, truth: str, predicted: str, levels: list[int]) -> DataFrame:
    """Error rate at each level where level 1 is right, and where it is wrong; a missing prediction is an error."""
    first = F.coalesce(at_level(predicted, 1) == at_level(truth, 1), F.lit(False))
    each = _levels(df.withColumn("_first", first), levels, lambda k: {"err": F.when(at_level(truth, k).isNotNull(), ~F.coalesce(at_level(predicted, k) == at_level(truth, k), F.lit(False)))}).where("err IS NOT NULL")
    return each.groupBy("level").agg(share(F.when(F.col("_first"), F.col("err"))).alias("err_if_right"), share(F.when(~F.col("_first"), F.col("err"))).alias("err_if_wrong"), F.count("*").alias("n"))


def sliced_report(df: DataFrame, truth: str, predicted: str, slices: list[str], levels: list[int]) -> DataFrame:
    """Accuracy overall and within each slice column, by level, from one pass with grouping sets."""
    judged = _levels(once(df, truth, predicted, *slices), levels, lambda k: {"ok": level_result(truth, predicted, k)}).where("ok IS NOT NULL")
    named = F.explode(F.array(F.struct(F.lit("overall").alias("slice"), F.lit("").alias("value")), *[F.struct(F.lit(s).alias("slice"), F.coalesce(F.col(s).cast("string"), F.lit("N/A")).alias("value")) for s in slices])).alias("s")
    return judged.select("level", "ok", named).groupBy("s.slice", "s.value", "level").agg(F.count("*").alias("n"), share(F.col("ok")).alias("accuracy"))


def best_and_worst(df: DataFrame, truth: str, predicted: str, min_rows: int = 10, each_end: int = 15) -> DataFrame:
    """Codes with the highest and lowest accuracy among those with min_rows rows or more."""
    rates = df.where(F.col(truth).isNotNull()).groupBy(F.col(truth).alias("code")).agg(F.count("*").alias("n"), share(F.coalesce(F.col(predicted) == F.col(truth), F.lit(False))).alias("accuracy")).where(F.col("n") >= min_rows)
    best = rates.orderBy(F.round("accuracy", 9).desc(), F.col("n").desc(), "code").limit(each_end).withColumn("side", F.lit("best"))
    return best.union(rates.orderBy(F.round("accuracy", 9), F.col("n").desc(), "code").limit(each_end).withColumn("side", F.lit("worst")))


def prefix_accuracy(df: DataFrame, truth: str, prefix: str, last: int = 12) -> DataFrame:
    """Per 2, 4 ... last characters: rows and right ones, where the common prefix is as long as asked or as the truth is."""
    each = df.where(F.length(truth) > 0).select(truth, prefix, F.explode(F.sequence(F.lit(2), F.lit(last), F.lit(2))).alias("k"))
    ok = F.coalesce(F.length(prefix) >= F.least(F.col("k"), F.length(truth)), F.lit(False))
    return each.groupBy("k").agg(F.count("*").alias("n"), F.count_if(ok).alias("n_ok"))
