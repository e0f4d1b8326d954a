"""Reports built on the metrics: confidence bins, high-confidence errors, heat maps, flags, thresholds, origins, text output."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codalith.functions.codes import at_level, cut, severity, truncate_code
from codalith.functions.text import metric_key
from codalith.operators.metrics import once, share

SEVERITIES = ("far-miss", "L2 faux", "L3 faux", "near-miss", "correct")


def _right(truth: str, predicted: str) -> Column:
    return F.coalesce(F.col(truth) == F.col(predicted), F.lit(False))


def confidence_bins(df: DataFrame, confidence: str, ok: Column, edges: list[float], labels: list[str]) -> DataFrame:
    """Per right-closed bin (the lowest edge included): rows, their share of all binned rows, accuracy, mean confidence."""
    binned = df.select(cut(confidence, edges, labels, include_lowest=True).alias("bin"), F.col(confidence).alias("c"), ok.alias("ok")).where("bin IS NOT NULL")
    counted = binned.groupBy("bin").agg(F.count("*").alias("n"), share(F.col("ok")).alias("accuracy"), F.avg("c").alias("mean_confidence"))
    total = counted.agg(F.sum("n").alias("total"))  # one row
    return counted.join(F.broadcast(total)).withColumn("share", F.col("n") / F.col("total")).drop("total")


def severity_counts(df: DataFrame, truth: str, predicted: str, confidence: str) -> DataFrame:
    """Every severity, those without rows too, with its rows and mean confidence."""
    counted = df.groupBy(severity(truth, predicted).alias("severity")).agg(F.count("*").alias("n"), F.avg(confidence).alias("mean_confidence"))
    every = df.sparkSession.createDataFrame([(s,) for s in SEVERITIES], "severity string")
    return every.join(counted, "severity", "left").select("severity", F.coalesce("n", F.lit(0)).cast("long").alias("n"), "mean_confidence")


def confident_errors(df: DataFrame, truth: str, predicted: str, confidence: str, threshold: float, limit: int = 10) -> DataFrame:
    """The most frequent wrong pairs at threshold or above, as 'truth -> predicted', with the share of such rows that are wrong."""
    sure = df.where(F.col(confidence) >= threshold).groupBy(F.col(truth).alias("t"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))
    wrong = ~F.coalesce(F.col("t") == F.col("p"), F.lit(False))
    totals = sure.agg((F.sum(F.when(wrong, F.col("n")).otherwise(0)) / F.sum("n")).alias("error_share"))  # one row
    pairs = sure.where(F.col("t") != F.col("p")).select(F.concat_ws(" -> ", "t", "p").alias("pair"), "n")
    return pairs.join(F.broadcast(totals)).orderBy(F.col("n").desc(), "pair").limit(limit)


def heat_map(df: DataFrame, truth: str, predicted: str, by: str, levels: list[int], top: int = 15) -> DataFrame:
    """Accuracy by level of the top most frequent groups of by; ties by name. The rows that stay on are groups, not observations."""
    group = F.coalesce(F.col(by).cast("string"), F.lit("N/A"))
    cells = df.select(group.alias("value"), F.explode(F.array(*[F.struct(F.lit(k).alias("level"), _level_right(truth, predicted, k).alias("ok")) for k in levels])).alias("x"))
    counted = cells.groupBy("value", "x.level").agg(F.count("*").alias("volume"), F.count("x.ok").alias("n"), share(F.col("x.ok")).alias("accuracy"))
    chosen = counted.where(F.col("level") == levels[0]).orderBy(F.col("volume").desc(), "value").limit(top).select("value")
    return counted.join(chosen, "value", "left_semi").where("n > 0")


def _level_right(truth: str, predicted: str, k: int) -> Column:
    return F.when(at_level(truth, k).isNotNull(), F.coalesce(at_level(truth, k) == at_level(predicted, k), F.lit(False)))


def accuracy_by_flags(df: DataFrame, truth: str, ranked: list[str], flags: dict[str, Column], levels: list[int], ks: list[int]) -> DataFrame:
    """Top-k accuracy by level, for rows where each flag holds and where it doesn't; a null flag doesn't hold."""
    hits = [F.struct(F.lit(k).alias("level"), F.lit(n).alias("k"), at_level(truth, k).alias("t"), F.array(*[at_level(c, k) for c in ranked[:n]]).alias("p")) for k in levels for n in ks]
    values = [F.struct(F.lit(name).alias("flag"), F.coalesce(c, F.lit(False)).alias("value")) for name, c in flags.items()]
    each = once(df, truth, *ranked, F.array(*values).alias("_flags")).select(F.explode("_flags").alias("f"), F.array(*hits).alias("h")).select("f.*", F.explode("h").alias("h"))
    judged = each.where("h.t IS NOT NULL AND h.p[0] IS NOT NULL")
    hit = F.coalesce(F.array_contains("h.p", F.col("h.t")), F.lit(False))
    return judged.groupBy("flag", "value", "h.level", "h.k").agg(F.count("*").alias("n"), share(hit).alias("accuracy"))


def top_k_within(df: DataFrame, truth: str, ranked: list[str], group_level: int, levels: list[int], k: int) -> DataFrame:
    """Top-k accuracy within each group of the truth at group_level, at the other levels."""
    others = [n for n in levels if n != group_level]
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("level"), at_level(truth, n).alias("t"), F.array(*[at_level(c, n) for c in ranked[:k]]).alias("p")) for n in others])).alias("x")
    each = df.select(at_level(truth, group_level).alias("group"), cells).where("x.t IS NOT NULL AND x.p[0] IS NOT NULL")
    return each.groupBy("group", "x.level").agg(F.count("*").alias("n"), share(F.coalesce(F.array_contains("x.p", F.col("x.t")), F.lit(False))).alias("accuracy"))


def scores_by_threshold(df: DataFrame, truth: str, predicted: str, confidence: str, levels: list[int], thresholds: list[float]) -> DataFrame:
    """Per level and threshold: coverage, accuracy, macro and weighted F1, from pair counts (one pass over df).

    Rows with truth and prediction at the level count; a class that isn't predicted has F1 0.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), at_level(truth, k).alias("t"), at_level(predicted, k).alias("p")) for k in levels])).alias("x")
    passed = F.array_compact(F.array(*[F.when(F.col(confidence) >= t, F.lit(float(t))) for t in thresholds]))
    rows = df.select(cells, passed.alias("passed")).where("x.t IS NOT NULL AND x.p IS NOT NULL").select("x.*", "passed")
    whole = rows.groupBy("level").agg(F.count("*").alias("total"))  # a row a level
    pairs = rows.select("level", "t", "p", F.explode("passed").alias("threshold")).groupBy("level", "threshold", "t", "p").agg(F.count("*").alias("n"))
    zero = F.lit(0).cast("long")
    sides = F.explode(F.array(
        F.struct(F.col("t").alias("class"), F.col("n").alias("support"), zero.alias("guessed"), F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(zero).alias("hits")),
        F.struct(F.col("p").alias("class"), zero.alias("support"), F.col("n").alias("guessed"), zero.alias("hits")),
    )).alias("s")
    classes = pairs.select("level", "threshold", sides).groupBy("level", "threshold", "s.class").agg(*[F.sum(f"s.{c}").alias(c) for c in ("support", "guessed", "hits")])
    f1 = 2 * F.col("hits") / (F.col("support") + F.col("guessed"))
    out = classes.groupBy("level", "threshold").agg(F.sum("support").alias("n"), (F.sum("hits") / F.sum("support")).alias("accuracy"), F.avg(f1).alias("macro_f1"), (F.sum(f1 * F.col("support")) / F.sum("support")).alias("weighted_f1"))
    return out.join(F.broadcast(whole), "level").withColumn("coverage", F.col("n") / F.col("total")).drop("total")


def error_sources(retrieval: DataFrame) -> DataFrame:
    """Where errors come from, out of metrics.retrieval_accuracy: missed by retrieval, or by the choice among what was retrieved."""
    error = 1 - F.col("accuracy")
    missed = 1 - F.col("retrieval_accuracy")
    chosen_badly = F.col("retrieval_accuracy") * (1 - F.col("generation_accuracy"))
    part = lambda c: F.when(error > 0, c / error).otherwise(0.0)
    return retrieval.withColumns({"error": error, "retrieval_share": part(missed), "generation_share": part(chosen_badly)})


def origin_recap(df: DataFrame, origin: str, ok: Column) -> DataFrame:
    """Per origin right, wrong and unjudged rows, for origins that have all three."""
    counted = df.groupBy(origin).agg(F.count_if(ok).alias("n_right"), F.count_if(~ok).alias("n_wrong"), F.count_if(ok.isNull()).alias("n_unknown"))
    return counted.where("n_right > 0 AND n_wrong > 0 AND n_unknown > 0")


def ties_histogram(ties: DataFrame, key: str) -> DataFrame:
    """How many keys have 1, 2, ... rows."""
    return ties.groupBy(key).agg(F.count("*").alias("n_ties")).groupBy("n_ties").agg(F.count("*").alias("n_keys"))


def flat_metrics(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(metric, value): a row for each value, its name made of the keys and cleaned for trackers."""
    named = [F.struct(F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("N/A")) for k in keys], F.lit(v)).alias("name"), F.col(v).cast("double").alias("value")) for v in values]
    rows = df.select(F.explode(F.array(*named)).alias("m")).where("m.value IS NOT NULL")
    return rows.select(metric_key(F.replace("m.name", F.lit("/"), F.lit("."))).alias("metric"), "m.value")


def text_report(metrics: DataFrame, title: str, keys: list[str], digits: int = 4) -> str:
    """A table of metrics, which is small by nature, as text with aligned columns, in order of its keys."""
    rows = [[f"{x:.{digits}f}" if isinstance(x, float) else "" if x is None else str(x) for x in r] for r in metrics.orderBy(*keys).collect()]
    widths = [max(len(x) for x in column) for column in zip(metrics.columns, *rows)]
    line = lambda cells: "  ".join(c.ljust(w) for c, w in zip(cells, widths)).rstrip()
    return "\n".join([title, "=" * len(title), line(metrics.columns), line(["-" * w for w in widths]), *map(line, rows)]) + "\n"


def html_report(metrics: DataFrame, title: str, keys: list[str], digits: int = 4) -> str:
    """The same table as a page of its own."""
    from html import escape

    cell = lambda x: f"{x:.{digits}f}" if isinstance(x, float) else "" if x is None else str(x)
    rows = "".join("<tr>" + "".join(f"<td>{escape(cell(x))}</td>" for x in r) + "</tr>\n" for r in metrics.orderBy(*keys).collect())
    head = "".join(f"<th>{escape(c)}</th>" for c in metrics.columns)
    return f'<!doctype html>\n<html><head><meta charset="utf-8"><title>{escape(title)}</title></head>\n<body><h1>{escape(title)}</h1>\n<table>\n<tr>{head}</tr>\n{rows}</table></body></html>\n'


def where_all(df: DataFrame, *, technical: bool | None = None, sources: list[str] | None = None, years: list[int] | None = None, min_confidence: float | None = None, severities: list[str] | None = None, prefix: str | None = None, contains: str | None = None, truth: str = "code", predicted: str = "predicted") -> DataFrame:
    """Rows that pass every filter that is given; values are literals, never parts of SQL texts."""
    first = truncate_code(truth, 1)
    tests = [
        None if technical is None else (F.coalesce(first.isin("98", "99"), F.lit(False)) == technical),
        None if sources is None else F.col("source").isin(sources),
        None if years is None else F.col("annee").isin(years),
        None if min_confidence is None else F.col("confidence") >= min_confidence,
        None if severities is None else severity(truth, predicted).isin(severities),
        None if prefix is None else F.startswith(F.col(truth), F.lit(prefix)),
        None if contains is None else F.contains(F.lower("label"), F.lit(contains.lower())),
    ]
    given = [t for t in tests if t is not None]
    return df.where(reduce(lambda a, b: a & b, given)) if given else df


def several_right(df: DataFrame, truth: str, predicted: str, budget: str, by: str) -> DataFrame:
    """Per group: rows, accuracy, budget and the share of the budget that is coded right; nulls are a group."""
    ok = _right(truth, predicted)
    return df.groupBy(by).agg(F.count("*").alias("n"), share(ok).alias("accuracy"), F.sum(budget).alias("budget"), (F.sum(F.when(ok, F.col(budget)).otherwise(0.0)) / F.sum(budget)).alias("weighted_accuracy"))
