"""Texts for retrieval and prompts: nomenclature documents, ancestor paths, the notices that matter for an observation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codalith.functions.codes import ancestors, depth, truncate_code

STRATEGIES = ("code_only", "basic", "with_exclusions", "with_hierarchy", "all_info")


def _section(title: str, column: str) -> Column:
    """title: text, or null without text, so that concat_ws leaves it out."""
    return F.when(F.length(F.trim(column)) > 0, F.concat(F.lit(f"{title}: "), F.col(column)))


def notice_text(strategy: str) -> Column:
    """One document of a notice with code, label, content, exclusions and path (labels of its ancestors)."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy: {strategy}")
    head = F.concat_ws(" - ", "code", "label")
    parts = {
        "code_only": [head],
        "basic": [head, _section("Contains", "content")],
        "with_exclusions": [head, _section("Contains", "content"), _section("Excludes", "exclusions")],
        "with_hierarchy": [head, _section("Path", "path"), _section("Contains", "content")],
        "all_info": [head, _section("Path", "path"), _section("Contains", "content"), _section("Excludes", "exclusions")],
    }[strategy]
    return F.concat_ws("\n\n", *parts)


# The titles of a notice's sections in Markdown.
GENERAL, INCLUSIONS, EXCLUSIONS = "Note générale:", "Inclusions:", "Exclusions:"
LINEAGE = "À niveau(x) plus agrégé(s), ce code fait partie des familles de produits suivants :"


def notice_markdown(strategy: str) -> Column:
    """The Markdown text of a notice with code, label, general, central, additional, exclusions, parents and parent_labels.

    The lineage is left out unless every parent has its label; empty sections are left out.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy: {strategy}")
    section = lambda title, c: F.when(F.length(c) > 0, F.concat(F.lit(f"**{title}** "), c))
    parts = [F.concat(F.lit("**"), "code", F.lit(": "), "label", F.lit("**"))]
    if strategy != "code_only":
        content = F.concat_ws(". ", *[F.when(F.length(c) > 0, F.trim(c)) for c in ("central", "additional")])
        parts += [section(GENERAL, F.col("general")), section(INCLUSIONS, content)]
    if strategy in ("with_hierarchy", "all_info"):
        whole = (F.size("parents") > 0) & (F.size("parents") == F.size("parent_labels"))
        parts.append(F.when(whole, section(LINEAGE, F.array_join(F.zip_with("parents", "parent_labels", lambda a, b: F.concat(a, F.lit(": "), b)), " > "))))
    if strategy in ("with_exclusions", "all_info"):
        parts.append(section(EXCLUSIONS, F.col("exclusions")))
    return F.concat_ws("\n\n", *parts)


def with_lineage(notices: DataFrame) -> DataFrame:
    """notices (code, label) with parents, all ancestors from the top, and parent_labels, the labels of those that have one."""
    up = notices.select("code", F.explode(ancestors("code")).alias("above"))
    named = up.join(notices.select(F.col("code").alias("above"), F.col("label").alias("name")), "above")
    gathered = named.groupBy("code").agg(F.array_sort(F.collect_list(F.struct(depth("above").alias("d"), "name"))).alias("a"))
    return notices.withColumn("parents", ancestors("code")).join(gathered, "code", "left").withColumn("parent_labels", F.transform("a", lambda x: x["name"])).drop("a")


def ancestor_paths(notices: DataFrame, separator: str = " > ") -> DataFrame:
    """notices (code, label) with path, the labels of all ancestors from the top; null where one is missing."""
    up = notices.select("code", F.explode(ancestors("code")).alias("above"))
    named = up.join(notices.select(F.col("code").alias("above"), F.col("label").alias("name")), "above")
    gathered = named.groupBy("code").agg(F.array_sort(F.collect_list(F.struct(depth("above").alias("d"), "name"))).alias("a"))
    joined = notices.join(gathered, "code", "left")
    return joined.withColumn("path", F.when(F.size("a") == depth("code") - 1, F.array_join(F.transform("a", lambda x: x["name"]), separator))).drop("a")


def nomenclature_block(notices: DataFrame, filter_by: Column | None = None) -> DataFrame:
    """All notices as one text, a line each in order of codes. A nomenclature is a bounded list."""
    rows = notices.where(filter_by) if filter_by is not None else notices
    lines = F.array_sort(F.collect_list(F.struct("code", F.concat_ws(" — ", "code", "label").alias("line"))))
    return rows.agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("block"))


def relevant_codes(observations: DataFrame, notices: DataFrame, predictions: list[str], key: str = "id") -> DataFrame:
    """(key, codes): for each observation levels 1 and 2 of the branches predicted, and what begins with a predicted level 2.

    Observations with the same predictions share one list, which is made once, by equi-joins alone: on
    level 1 for the shallow codes, on the beginnings of level 2 for the deeper ones. Without any
    prediction the list is the whole nomenclature. A nomenclature is a bounded list, so are these.
    """
    known = F.array_distinct(F.array_compact(F.array(*predictions)))
    own = observations.select(key, F.array_sort(known).alias("p"))
    sets = own.select("p").where(F.size("p") > 0).distinct()
    branches = sets.select("p", F.explode(F.array_distinct(F.transform("p", lambda c: truncate_code(c, 1)))).alias("at"))
    seconds = F.filter("p", lambda c: depth(c) >= 2)
    twigs = sets.select("p", F.explode(F.array_distinct(F.transform(seconds, lambda c: truncate_code(c, 2)))).alias("at"))
    second = truncate_code("code", 2)
    shortest = F.length(truncate_code("code", 1)) + 2
    beginnings = F.transform(F.sequence(shortest, F.length(second)), lambda n: F.substring(second, F.lit(1), n))
    shallow = notices.where(depth("code") <= 2).select("code", truncate_code("code", 1).alias("at"))
    deep = notices.where(depth("code") > 2).select("code", F.explode(beginnings).alias("at"))
    near = branches.join(shallow, "at").union(twigs.join(deep, "at")).select("p", "code")
    lists = near.groupBy("p").agg(F.array_sort(F.collect_set("code")).alias("listed"))
    whole = notices.agg(F.array_sort(F.collect_set("code")).alias("whole"))  # one row
    return own.join(lists, "p", "left").join(F.broadcast(whole)).select(key, F.when(F.size("p") == 0, F.col("whole")).otherwise(F.coalesce("listed", F.array().cast("array<string>"))).alias("codes"))


def judge_prompt(label: str, shop: str, budget: str, candidates: str) -> Column:
    """A request for one observation: shop and price blocks only where they are known."""
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Product: "), F.col(label)),
        F.when(F.length(shop) > 0, F.concat(F.lit("Shop: "), F.col(shop))),
        F.when(F.coalesce(F.col(budget), F.lit(0.0)) != 0, F.concat(F.lit("Price: "), F.format_string("%.2f", F.col(budget)), F.lit(" euros"))),
        F.concat(F.lit("Candidates: "), F.array_join(candidates, ", ")),
    )


def aligned_codes(answer: Column, n: int) -> Column:
    """A fenced JSON list of codes, cut or filled with nulls to n entries."""
    inner = F.regexp_extract(answer, "(?s)\\[.*\\]", 0)
    found = F.coalesce(F.from_json(inner, "array<string>"), F.array().cast("array<string>"))
    return F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.try_element_at(found, i))
