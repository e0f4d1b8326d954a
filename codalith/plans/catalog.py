"""Registry of the library's queries over whole tables, each with SQL that computes the same rows independently."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codalith.functions import codes, text
from codalith.operators import classifiers, decision, documents, hierarchy, ingest, metrics, rules, similarity, training, vectors
from codalith.plans.observations import CTE, observations
from codalith.sources import readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
FLAGSHIP = "regex_classification_by_source"


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# Pieces of SQL.
def _cut(c: str, n) -> str:
    return f"array_to_string(string_split({c}, '.')[1:{n}], '.')"


def _depth(c: str) -> str:
    return f"len(string_split({c}, '.'))"


def _at(c: str, n) -> str:
    return f"CASE WHEN {_depth(c)} >= {n} THEN {_cut(c, n)} END"


def _result(t: str, p: str, k) -> str:
    return f"CASE WHEN coalesce({_depth(t)}, 0) < {k} THEN NULL WHEN coalesce({_depth(p)}, 0) < {k} THEN false ELSE {_cut(t, k)} = {_cut(p, k)} END"


_LEVELS = [1, 2, 3, 4]
_L = "(SELECT unnest([1, 2, 3, 4]) AS level)"

# ---- text and rules


_FOLD = "lower(regexp_replace(strip_accents(replace(replace(replace(replace(regexp_replace({c}, '\\s+', ' ', 'g'), 'œ', 'oe'), 'Œ', 'OE'), 'æ', 'ae'), 'Æ', 'AE')), '[^\\x00-\\x7F]', '', 'g'))"
_RULE_CASE = "CASE " + " ".join("WHEN regexp_matches(l_pr, '{}', 'i') THEN '{}'".format(p.replace("'", "''"), c) for p, c in rules.RULES) + " END"


@query(CTE + f" SELECT id, {_FOLD.format(c='label')} AS l_pr FROM obs")
def normalize_labels(spark, d):
    return observations(spark, d).select("id", text.normalize_label("label").alias("l_pr"))


@query(f"SELECT doc_id, CAST(i AS INTEGER) AS line_no, {_FOLD.format(c='raw')} AS line FROM (SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i, unnest(string_split(text, chr(10))) AS raw FROM documents)")
def normalize_lines(spark, d):
    lines = F.posexplode(F.split("text", "\n")).alias("at", "raw")
    split = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", lines)
    return split.select("doc_id", (F.col("at") + 1).alias("line_no"), text.normalize_label("raw").alias("line"))


#: Enough for the tests' labels; callers give their own list.
STOPWORDS = ["de", "la", "le", "les", "du", "des", "et", "au"]


_STRONG = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(label, ' ')), '\\brien\\b', '', 'g'), '[^\\p{L}\\p{N}\\p{M}_\\s]+', ' ', 'g'), '\\brien\\b', '', 'g'), '[0-9+]', ' ', 'g')"


@query(CTE + f", t AS (SELECT id, list_filter(string_split_regex(trim({_STRONG}), '\\s+'), lambda w: length(w) > 1) AS w FROM obs), u AS (SELECT id, list_filter(w, lambda x, i: list_position(w, x) = i) AS w FROM t WHERE len(w) > 0) SELECT id, regexp_replace(strip_accents(array_to_string(list_filter(w, lambda x: NOT list_contains({STOPWORDS}, x)), ' ')), '[^\\x00-\\x7F]', '', 'g') AS s_pr FROM u")
def strong_clean_labels(spark, d):
    return observations(spark, d).select("id", text.strong_clean("label", STOPWORDS).alias("s_pr")).where("s_pr IS NOT NULL")


@query(CTE + f", n AS (SELECT *, {_FOLD.format(c='label')} AS l_pr FROM obs), r AS (SELECT source, code, {_RULE_CASE} AS predict_code FROM n) SELECT source, predict_code, count(*) AS n, round(avg(CASE WHEN coalesce(code = predict_code, false) THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM r GROUP BY source, predict_code")
def regex_classification_by_source(spark, d):
    coded = rules.apply_rules(observations(spark, d).withColumn("l_pr", text.normalize_label("label")), "l_pr")
    ok = F.coalesce(F.col("code") == F.col("predict_code"), F.lit(False))
    return _rounded(coded.groupBy("source", "predict_code").agg(F.count("*").alias("n"), metrics.share(ok).alias("accuracy")), "accuracy")


@query(CTE + ", n AS (SELECT id, '//' || CAST(budget AS VARCHAR) || ' EUR' AS t FROM obs) SELECT id, CAST(nullif(regexp_extract(replace(replace(t, '//', ''), ',', '.'), '^[0-9]+(\\.[0-9]+)?', 0), '') AS DOUBLE) AS price, TRY_CAST(replace(trim(t), ',', '.') AS DOUBLE) AS amount FROM n")
def price_cleaning(spark, d):
    raw = observations(spark, d).withColumn("t", F.concat(F.lit("//"), F.col("budget").cast("string"), F.lit(" EUR")))
    return raw.select("id", text.price("t").alias("price"), text.amount("t").alias("amount"))


@query("SELECT p_partkey, CAST(i - 1 AS INTEGER) AS at, [p_name, p_type, p_brand][i] AS item FROM part, (SELECT unnest([1, 2, 3]) AS i)")
def parse_list_answers(spark, d):
    lines = F.concat_ws("\n", F.lit("Voici des exemples :"), F.concat(F.lit("1. "), "p_name"), F.concat(F.lit("- "), "p_type"), F.lit(""), F.concat(F.lit("12) "), "p_brand"))
    return spark.read.parquet(f"{d}/part.parquet").select("p_partkey", F.posexplode(text.list_items(lines)).alias("at", "item"))


# ---- codes


@query(CTE + f" SELECT id, {_cut('code', 3)} AS level3, {_depth('code')} AS depth, CASE WHEN {_depth('code')} > 1 THEN {_cut('code', '-2')} END AS parent, coalesce(starts_with(code, '98') OR starts_with(code, '99'), false) AS technical FROM obs")
def code_parts(spark, d):
    return observations(spark, d).select("id", codes.truncate_code("code", 3).alias("level3"), codes.depth("code").alias("depth"), codes.parent_code("code").alias("parent"), F.coalesce(codes.is_technical("code"), F.lit(False)).alias("technical"))


@query(CTE + ", a AS (SELECT id, code, " + _depth("code") + " AS d FROM obs WHERE code IS NOT NULL), e AS (SELECT id, code, unnest(range(1, d)) AS i FROM a) SELECT id, " + _cut("code", "i") + " AS ancestor FROM e")
def code_ancestors(spark, d):
    return observations(spark, d).where("code IS NOT NULL").select("id", F.explode(codes.ancestors("code")).alias("ancestor"))


@query(CTE + " SELECT id, " + ", ".join(f"{_at('code', k)} AS level{k}" for k in _LEVELS) + " FROM obs")
def level_columns(spark, d):
    return observations(spark, d).select("id", *[codes.level_padded("code", k).alias(f"level{k}") for k in _LEVELS])


def _prefix_sql(a: str, b: str) -> str:
    return f"left({a}, list_max(list_filter([2, 4, 6, 8, 10, 12], lambda k: left({a}, k) = left({b}, k))))"


@query(CTE + f" SELECT id, {_prefix_sql('code', 'predicted')} AS common FROM obs")
def common_code_prefix(spark, d):
    return observations(spark, d).select("id", codes.common_prefix("code", "predicted").alias("common"))


_SEVERITY = f"CASE WHEN {_at('code', 4)} IS NULL OR {_at('predicted', 4)} IS NULL THEN NULL WHEN {_at('code', 1)} <> {_at('predicted', 1)} THEN 'far-miss' WHEN {_at('code', 2)} <> {_at('predicted', 2)} THEN 'L2 faux' WHEN {_at('code', 3)} <> {_at('predicted', 3)} THEN 'L3 faux' WHEN {_at('code', 4)} <> {_at('predicted', 4)} THEN 'near-miss' ELSE 'correct' END"


@query(CTE + f" SELECT {_SEVERITY} AS severity, count(*) AS n, round(avg(confidence), 6) AS mean_confidence, round(median(confidence), 6) AS median_confidence FROM obs GROUP BY 1")
def error_severity(spark, d):
    rows = observations(spark, d).withColumn("severity", codes.severity("code", "predicted"))
    medians = metrics.quantiles(rows, "confidence", [0.5], F.col("severity"))
    median = F.coalesce(*[F.when(F.col("severity").eqNullSafe(F.lit(s)), F.lit(m)) for s, (m,) in medians.items()], F.lit(None).cast("double"))
    out = rows.groupBy("severity").agg(F.count("*").alias("n"), F.avg("confidence").alias("mean_confidence")).withColumn("median_confidence", median)
    return _rounded(out, "mean_confidence", "median_confidence")


_BUDGET = "CASE " + " ".join(f"WHEN budget BETWEEN {a} AND {b} THEN '{a}-{b} €'" for a, b in zip(codes.BUDGET_BOUNDS, codes.BUDGET_BOUNDS[1:])) + " WHEN budget > 100 THEN '100+ €' END"


@query(CTE + f" SELECT {_BUDGET} AS budget_class, count(*) AS n, round(avg(CASE WHEN code = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM obs GROUP BY 1")
def budget_class_accuracy(spark, d):
    ok = F.coalesce(F.col("code") == F.col("predicted"), F.lit(False))
    return _rounded(observations(spark, d).groupBy(codes.budget_class("budget").alias("budget_class")).agg(F.count("*").alias("n"), metrics.share(ok).alias("accuracy")), "accuracy")


# ---- ingest


@query(CTE + " SELECT code, shop, annee, round(nullif(sum(coalesce(budget, 0)), 0), 4) AS budget, count(*) AS n_obs FROM obs GROUP BY code, shop, annee")
def budget_by_code_and_shop(spark, d):
    return _rounded(ingest.sum_budget(observations(spark, d), ["code", "shop", "annee"], "budget"), "budget", digits=4)


@query(CTE + " SELECT label, code, count(*) AS n FROM obs GROUP BY label, code HAVING count(*) > 1")
def duplicate_labels(spark, d):
    return ingest.duplicates(observations(spark, d), ["label", "code"])


@query(CTE + " SELECT id, label, code FROM obs WHERE shop IN (SELECT shop FROM obs GROUP BY shop HAVING count(DISTINCT code) > 1)")
def shops_with_several_codes(spark, d):
    return ingest.several_codes(observations(spark, d).select("id", "label", "code", "shop"), "shop", "code").select("id", "label", "code")


@query(CTE + ", m AS (SELECT DISTINCT shop, CASE WHEN shop IS NULL THEN 'unknown' ELSE 'type ' || left(shop, 1) END AS shop_kind FROM obs) SELECT obs.id, m.shop_kind FROM obs LEFT JOIN m ON obs.shop IS NOT DISTINCT FROM m.shop")
def attach_shop_types(spark, d):
    rows = observations(spark, d).select("id", "shop")
    mapping = rows.select("shop").distinct().withColumn("shop_kind", F.when(F.col("shop").isNull(), "unknown").otherwise(F.concat(F.lit("type "), F.left("shop", F.lit(1)))))
    return ingest.attach(rows, mapping, "shop").select("id", "shop_kind")


@query(CTE + " SELECT id, 'rules' AS origin, label, CAST(NULL AS DOUBLE) AS budget FROM obs WHERE source = 'F' UNION ALL SELECT id, 'shops', NULL, budget FROM obs WHERE source <> 'F'")
def stacked_sources(spark, d):
    rows = observations(spark, d)
    return ingest.stack([rows.where("source = 'F'").select("id", F.lit("rules").alias("origin"), "label"), rows.where("source <> 'F'").select("id", F.lit("shops").alias("origin"), "budget")])


@query(CTE + " SELECT id, label FROM obs WHERE label IS NULL OR label NOT IN ('divers', 'carte bancaire')")
def without_uncodable(spark, d):
    listed = spark.createDataFrame([("divers",), ("carte bancaire",)], "label string")
    return ingest.without_listed(observations(spark, d).select("id", "label"), "label", listed)


@query(CTE + " SELECT id, 'all' AS logic FROM obs WHERE num % 2 = 0 AND num % 3 = 0 UNION ALL SELECT id, 'any' FROM obs WHERE num % 2 = 0 OR num % 3 = 0 UNION ALL SELECT id, 'only' FROM obs WHERE num % 2 = 0 AND num % 3 = 0 AND num % 5 <> 0 UNION ALL SELECT id, 'none' FROM obs WHERE num % 2 <> 0 AND num % 3 <> 0")
def source_logic_filters(spark, d):
    flags = {f"in_{m}": F.col("num") % m == 0 for m in (2, 3, 5)}
    rows = observations(spark, d).withColumns(flags)
    parts = [ingest.multi_source(rows, ["in_2", "in_3"], how, list(flags)).select("id", F.lit(how).alias("logic")) for how in ("all", "any", "only", "none")]
    return ingest.stack(parts)


@query("SELECT l_returnflag, l_linestatus, CAST(count(*) FILTER (WHERE l_discount > 0.05) AS BIGINT) AS n_discounted, round(100.0 * count(*) FILTER (WHERE l_discount > 0.05) / count(*), 2) AS percent, round(sum(l_extendedprice), 2) AS price FROM lineitem GROUP BY ALL")
def filtered_counts(spark, d):
    rows = spark.read.parquet(f"{d}/lineitem.parquet").groupBy("l_returnflag", "l_linestatus")
    hit = F.count_if(F.col("l_discount") > 0.05)
    return rows.agg(hit.alias("n_discounted"), F.round(100.0 * hit / F.count("*"), 2).alias("percent"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


# ---- similarity


def _names(spark, d, column: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/part.parquet").select(F.col(column).alias(name)).distinct()


_LCS_CTE = """WITH a AS (SELECT DISTINCT p_name AS s1 FROM part), b AS (SELECT DISTINCT p_name || ' x' AS s2 FROM part),
p AS (SELECT s1, s2 FROM a, b WHERE s1 <> s2),
m AS (SELECT s1, s2, i, max(n) AS size FROM (SELECT s1, s2, i, unnest(range(1, length(s1) - i + 2)) AS n FROM (SELECT s1, s2, unnest(range(1, length(s1) + 1)) AS i FROM p)) WHERE contains(upper(s2), upper(substr(s1, i, n))) GROUP BY ALL),
t AS (SELECT s1, s2, max(size) AS size, min_by(i, (-size) * 1000 + i) AS i FROM m GROUP BY s1, s2),
pairs AS (SELECT s1, s2, round(1 - CAST(size AS DOUBLE) / greatest(length(s1), length(s2)), 6) AS distance, substr(s1, i, size) AS common_substring, round(CAST(size AS DOUBLE) / length(s1), 6) AS prop_in_s1, round(CAST(size AS DOUBLE) / length(s2), 6) AS prop_in_s2 FROM t WHERE round(1 - CAST(size AS DOUBLE) / greatest(length(s1), length(s2)), 9) <= 0.8)"""


def _pairs(spark, d) -> DataFrame:
    marked = _names(spark, d, "p_name", "s2").select(F.concat("s2", F.lit(" x")).alias("s2"))
    return similarity.similar_pairs(_names(spark, d, "p_name", "s1"), marked)


@query(_LCS_CTE + " SELECT * FROM pairs")
def substring_similarity_join(spark, d):
    return _rounded(_pairs(spark, d), "distance", "prop_in_s1", "prop_in_s2")


@query(_LCS_CTE + ", r AS (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY distance, prop_in_s2 DESC, s2) AS rn FROM pairs) SELECT s1, s2, distance FROM r WHERE rn = 1")
def best_reference_labels(spark, d):
    return _rounded(similarity.best_reference(_pairs(spark, d)).select("s1", "s2", "distance"), "distance")


@query(_LCS_CTE + ", r AS (SELECT *, rank() OVER (PARTITION BY s1 ORDER BY distance) AS rk FROM pairs) SELECT s1, s2, count(*) OVER (PARTITION BY s1) AS n_ties FROM r WHERE rk = 1")
def nearest_reference_ties(spark, d):
    return similarity.nearest_ties(_pairs(spark, d)).select("s1", "s2", "n_ties")


@query("SELECT s1, s1 AS s2, 0.0::DOUBLE AS distance FROM (SELECT p_name AS s1 FROM part UNION SELECT p_type FROM part) WHERE length(s1) > 0 AND s1 IN (SELECT p_type FROM part UNION SELECT p_brand FROM part)")
def exact_label_matches(spark, d):
    labels = _names(spark, d, "p_name", "s1").union(_names(spark, d, "p_type", "s1"))
    references = _names(spark, d, "p_type", "s2").union(_names(spark, d, "p_brand", "s2"))
    return similarity.exact_pairs(labels, references).select("s1", "s2", "distance")


# ---- hierarchy

_TREE = CTE + f", e AS (SELECT DISTINCT code, {_depth('code')} AS d FROM obs WHERE code IS NOT NULL), tree AS (SELECT DISTINCT {_cut('code', 'i')} AS code FROM (SELECT code, unnest(range(1, d + 1)) AS i FROM e))"


def _tree(spark, d) -> DataFrame:
    return hierarchy.with_ancestors(observations(spark, d))


_KIDS = f", kids AS (SELECT t.code, count(c.code) AS n_children FROM tree t LEFT JOIN tree c ON {_depth('c.code')} = {_depth('t.code')} + 1 AND starts_with(c.code, t.code || '.') GROUP BY t.code)"


@query(_TREE + _KIDS + " SELECT code, n_children FROM kids")
def children_per_code(spark, d):
    return hierarchy.children_counts(_tree(spark, d))


_MAPPING = f", lin AS (SELECT code, {_depth('code')} AS d FROM kids WHERE n_children <= 1), up AS (SELECT code, d, {_cut('code', 'i')} AS above, i FROM (SELECT code, d, unnest(range(1, d)) AS i FROM lin)), deep AS (SELECT code, max(i) AS i FROM up WHERE above NOT IN (SELECT code FROM lin) GROUP BY code), mapping AS (SELECT code, {_cut('code', 'coalesce(i, 0) + 1')} AS code_parent_equivalent FROM lin LEFT JOIN deep USING (code))"


@query(_TREE + _KIDS + _MAPPING + " SELECT * FROM mapping")
def pruned_hierarchy(spark, d):
    return hierarchy.prune_mapping(_tree(spark, d))


@query(_TREE + _KIDS + _MAPPING + f" SELECT obs.id, coalesce(m.code_parent_equivalent, {_cut('obs.code', 3)}) AS code_final FROM obs LEFT JOIN mapping m ON m.code = {_cut('obs.code', 3)}")
def truncated_and_pruned(spark, d):
    return hierarchy.truncate_and_prune(observations(spark, d).select("id", "code"), hierarchy.prune_mapping(_tree(spark, d)), level=3).select("id", "code_final")


@query(_TREE + " SELECT code FROM tree t WHERE NOT EXISTS (SELECT 1 FROM tree c WHERE starts_with(c.code, t.code || '.'))")
def leaf_codes(spark, d):
    return hierarchy.leaves(_tree(spark, d))


# ---- decision


@query(CTE + " SELECT id, CASE WHEN confidence >= 0.9 AND predicted IS NOT NULL AND coalesce(lcs_code = predicted, true) AND coalesce(rag_code = predicted, true) THEN predicted END AS decided FROM obs")
def consensus_decision(spark, d):
    return observations(spark, d).select("id", decision.consensus("predicted", "confidence", ["lcs_code", "rag_code"]).alias("decided"))


_ANSWER = "CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN '```json' || {nl} || props || {nl} || '```' WHEN 2 THEN 'Answer: ' || props || ' done' ELSE 'no idea' END"


@query("SELECT event_id, event_id % 4 <> 3 AS parsed, CASE WHEN event_id % 4 <> 3 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events")
def judge_answers(spark, d):
    raw = spark.read.parquet(f"{d}/events.parquet").selectExpr("event_id", _ANSWER.format(nl="chr(10)") + " AS answer")
    found = raw.withColumn("json", decision.answer_json(F.col("answer")))
    return found.select("event_id", F.col("json").isNotNull().alias("parsed"), F.get_json_object("json", "$.k").cast("long").alias("k"))


@query(CTE + ", c AS (SELECT id, confidence AS a, 1 - confidence / 2 AS b, 0.5 + confidence / 4 AS c FROM obs) SELECT id, CASE WHEN a < 0.4 THEN 0 WHEN b < 0.4 THEN 1 WHEN c < 0.4 THEN 2 ELSE 3 END AS stop_level, round(CASE WHEN a < 0.4 THEN 1 WHEN b < 0.4 THEN a WHEN c < 0.4 THEN a * b ELSE a * b * c END, 6) AS combined FROM c")
def combined_confidence(spark, d):
    rows = observations(spark, d).withColumn("s", decision.stopped_confidence(F.array(F.col("confidence"), 1 - F.col("confidence") / 2, 0.5 + F.col("confidence") / 4), 0.4))
    return rows.select("id", F.col("s.level").alias("stop_level"), F.round("s.product", 6).alias("combined"))


_SCORES = "SELECT id, 'p' || CAST(num % 4 AS STRING) AS parent, 'c' || CAST(j AS STRING) AS class, CAST((num * (j + 3)) % 7 AS DOUBLE) / 10 AS p FROM obs"


@query(CTE + f", j AS (SELECT unnest(range(0, 5)) AS j), s AS ({_SCORES}, j), v AS (SELECT 'p' || CAST(a AS STRING) AS parent, 'c' || CAST(b AS STRING) AS class FROM (SELECT unnest(range(0, 3)) AS a), (SELECT unnest(range(0, 5)) AS b) WHERE (a + b) % 2 = 0), k AS (SELECT s.*, v.class IS NOT NULL AS ok, s.parent IN (SELECT parent FROM v) AS has FROM s LEFT JOIN v USING (parent, class)), u AS (SELECT *, sum(p) OVER (PARTITION BY id) AS mass, count(*) OVER (PARTITION BY id) AS n FROM k WHERE ok OR NOT has), q AS (SELECT id, class, CASE WHEN mass > 0 THEN p / mass ELSE 1.0 / n END AS q FROM u), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY q DESC, class) AS rn FROM q) SELECT id, class, round(q, 6) AS q FROM r WHERE rn = 1")
def masked_child_classes(spark, d):
    rows = observations(spark, d).select("id", "num", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("j"))
    scores = rows.selectExpr("id", "'p' || CAST(num % 4 AS STRING) AS parent", "'c' || CAST(j AS STRING) AS class", "CAST((num * (j + 3)) % 7 AS DOUBLE) / 10 AS p")
    valid = spark.createDataFrame([(f"p{a}", f"c{b}") for a in range(3) for b in range(5) if (a + b) % 2 == 0], "parent string, class string")
    return _rounded(decision.masked_argmax(scores, valid), "q")


@query(CTE + ", b AS (SELECT id, num, unnest(range(0, 3)) AS j FROM obs), x AS (SELECT id, num, 'n' || CAST(j AS STRING) AS code, ln(CAST(num % 5 + j + 1 AS DOUBLE) / 10) AS logp FROM b), g AS (SELECT id, code || CAST(h AS STRING) AS code, round(logp + ln(CAST(num % 3 + h + 1 AS DOUBLE) / 8), 9) AS logp FROM x, (SELECT unnest(range(0, 3)) AS h)), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY logp DESC, code) AS rn FROM g) SELECT id, code, round(logp, 6) AS logp FROM r WHERE rn <= 4")
def beam_search_step(spark, d):
    rows = observations(spark, d).select("id", "num", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("j")).selectExpr("id", "num", "'n' || CAST(j AS STRING) AS code", "CAST(num % 5 + j + 1 AS DOUBLE) / 10 AS p")
    beams = rows.select("id", "code", F.log("p").alias("logp"))
    scores = rows.select("id", "num", "code", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("h")).selectExpr("id", "code", "code || CAST(h AS STRING) AS next", "CAST(num % 3 + h + 1 AS DOUBLE) / 8 AS p")
    return _rounded(decision.beam_step(beams, scores, 4), "logp")


# ---- metrics


@query(CTE + f", m AS (SELECT code, 'predicted' AS method, predicted AS p FROM obs UNION ALL SELECT code, 'lcs_code', lcs_code FROM obs UNION ALL SELECT code, 'rag_code', rag_code FROM obs), e AS (SELECT method, level, {_result('code', 'p', 'level')} AS ok FROM m, {_L}) SELECT method, level, count(*) AS n, CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS n_ok, round(avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM e WHERE ok IS NOT NULL GROUP BY method, level")
def accuracy_by_method_and_level(spark, d):
    return _rounded(metrics.report_accuracy(observations(spark, d), "code", ["predicted", "lcs_code", "rag_code"], _LEVELS), "accuracy")


@query(CTE + f", e AS (SELECT shop, {_result('code', 'predicted', 2)} AS ok FROM obs) SELECT shop, count(*) AS n, round(avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM e WHERE ok IS NOT NULL GROUP BY shop HAVING count(*) >= 30")
def accuracy_by_shop(spark, d):
    return _rounded(metrics.grouped_accuracy(observations(spark, d), "code", "predicted", "shop", 2), "accuracy")


_RAG = CTE + f", f AS (SELECT *, [predicted, top2, top3] AS retrieved FROM obs), g AS (SELECT 'all' AS filter, * FROM f UNION ALL SELECT 'codable', * FROM f WHERE code IS NOT NULL AND predicted IS NOT NULL UNION ALL SELECT 'confident', * FROM f WHERE confidence >= 0.7), e AS (SELECT filter, level, source, {_cut('predicted', 'level')} IS NOT DISTINCT FROM {_cut('code', 'level')} AS ok, coalesce({_cut('predicted', 'level')} = {_cut('code', 'level')}, false) OR coalesce({_cut('top2', 'level')} = {_cut('code', 'level')}, false) OR coalesce({_cut('top3', 'level')} = {_cut('code', 'level')}, false) AS found FROM g, {_L})"
_RAG_OUT = "count(*) AS n, round(avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END), 6) AS accuracy, round(avg(CASE WHEN found THEN 1.0 ELSE 0.0 END), 6) AS retrieval_accuracy, round(coalesce(avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END) FILTER (WHERE found), 0), 6) AS generation_accuracy"


def _retrieval(spark, d, by=None) -> DataFrame:
    rows = observations(spark, d).withColumn("retrieved", F.array("predicted", "top2", "top3"))
    filters = {"all": F.lit(True), "codable": F.col("code").isNotNull() & F.col("predicted").isNotNull(), "confident": F.col("confidence") >= 0.7}
    return _rounded(metrics.retrieval_accuracy(rows, "code", "predicted", "retrieved", _LEVELS, filters, by), "accuracy", "retrieval_accuracy", "generation_accuracy")


@query(_RAG + f" SELECT filter, level, {_RAG_OUT} FROM e GROUP BY filter, level")
def retrieval_metrics(spark, d):
    return _retrieval(spark, d)


@query(_RAG + f" SELECT source, filter, level, {_RAG_OUT} FROM e GROUP BY source, filter, level")
def retrieval_metrics_by_source(spark, d):
    return _retrieval(spark, d, ["source"])


_TOPK = CTE + f", e AS (SELECT source, level, {_at('code', 'level')} AS t, {_at('predicted', 'level')} AS p1, {_at('top2', 'level')} AS p2, {_at('top3', 'level')} AS p3 FROM obs, {_L}), h AS (SELECT source, level, t = p1 AS k1, t = p1 OR coalesce(t = p2, false) AS k2, t = p1 OR coalesce(t = p2, false) OR coalesce(t = p3, false) AS k3 FROM e WHERE t IS NOT NULL AND p1 IS NOT NULL), u AS (SELECT source, level, 1 AS k, k1 AS hit FROM h UNION ALL SELECT source, level, 2, k2 FROM h UNION ALL SELECT source, level, 3, k3 FROM h)"


@query(_TOPK + " SELECT level, k, count(*) AS n, round(avg(CASE WHEN hit THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM u GROUP BY level, k")
def top_k_by_level(spark, d):
    return _rounded(metrics.top_k_accuracy(observations(spark, d), "code", ["predicted", "top2", "top3"], _LEVELS, [1, 2, 3]), "accuracy")


@query(_TOPK + " SELECT source, level, k, count(*) AS n, round(avg(CASE WHEN hit THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM u GROUP BY source, level, k")
def top_k_by_source(spark, d):
    return _rounded(metrics.top_k_accuracy(observations(spark, d), "code", ["predicted", "top2", "top3"], _LEVELS, [1, 2, 3], ["source"]), "accuracy")


_CLASS = CTE + f", b AS (SELECT {_cut('code', 1)} AS t, {_cut('predicted', 1)} AS p FROM obs WHERE code IS NOT NULL AND predicted IS NOT NULL), c AS (SELECT class, count(*) FILTER (WHERE t = class) AS support, count(*) FILTER (WHERE p = class) AS guessed, count(*) FILTER (WHERE t = class AND p = class) AS hits FROM b, (SELECT t AS class FROM b UNION SELECT p FROM b) GROUP BY class), s AS (SELECT class, support, guessed, CASE WHEN guessed > 0 THEN hits / guessed ELSE 0 END AS precision, CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall FROM c), f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM s)"


def _first_levels(spark, d) -> DataFrame:
    return observations(spark, d).select(codes.truncate_code("code", 1).alias("t"), codes.truncate_code("predicted", 1).alias("p"))


@query(_CLASS + " SELECT class, support, guessed, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM f")
def classification_report(spark, d):
    return _rounded(metrics.class_report(_first_levels(spark, d), "t", "p"), "precision", "recall", "f1")


@query(_CLASS + " SELECT " + ", ".join(f"round(avg({c}), 6) AS macro_{c}, round(sum({c} * support) / sum(support), 6) AS weighted_{c}" for c in ("precision", "recall", "f1")) + ", CAST(sum(support) AS BIGINT) AS n, round(sum(recall * support) / sum(support), 6) AS accuracy FROM f")
def averaged_scores(spark, d):
    out = metrics.averaged_report(_first_levels(spark, d), "t", "p")
    return _rounded(out, *[c for c in out.columns if c != "n"])


@query(CTE + ", b AS (SELECT confidence AS c, code = predicted AS ok FROM obs WHERE code IS NOT NULL AND predicted IS NOT NULL), t AS (SELECT unnest(range(0, 21)) / 20.0 AS threshold) SELECT CAST(threshold AS DOUBLE) AS threshold, round(avg(CASE WHEN c >= threshold THEN 1.0 ELSE 0.0 END), 6) AS coverage, round(coalesce(avg(CASE WHEN c >= threshold THEN CASE WHEN ok THEN 1.0 ELSE 0.0 END END), 0), 6) AS accuracy FROM b, t GROUP BY threshold")
def coverage_curve(spark, d):
    return _rounded(metrics.threshold_curve(observations(spark, d), "confidence", F.col("code") == F.col("predicted")), "coverage", "accuracy")


@query(CTE + ", w AS (SELECT code AS truth, predicted, count(*) AS n FROM obs WHERE code <> predicted GROUP BY ALL) SELECT truth, predicted, n, n / sum(n) OVER () AS share FROM w ORDER BY n DESC, truth, predicted LIMIT 20".replace("n / sum(n) OVER () AS share", "round(n / sum(n) OVER (), 6) AS share"))
def top_confusions(spark, d):
    return _rounded(metrics.confusion_pairs(observations(spark, d), "code", "predicted"), "share")


_CLASSES = [f"{n:02d}" for n in range(1, 13)] + list(codes.TECHNICAL)


@query(CTE + f", b AS (SELECT {_cut('code', 1)} AS truth, {_cut('predicted', 1)} AS p FROM obs WHERE code IS NOT NULL AND predicted IS NOT NULL) SELECT truth, " + ", ".join(f"round(avg(CASE WHEN p = '{c}' THEN 1.0 ELSE 0.0 END), 6) AS to_{c}" for c in _CLASSES) + " FROM b GROUP BY truth")
def confusion_shares(spark, d):
    out = metrics.confusion_matrix(_first_levels(spark, d), "t", "p", _CLASSES)
    return _rounded(out, *[c for c in out.columns if c != "truth"])


@query(CTE + ", q AS (SELECT list_distinct(quantile_cont(budget, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1])) AS e FROM obs), b AS (SELECT CASE WHEN budget IS NOT NULL THEN greatest(len(list_filter(e, lambda x: x < budget)), 1) END AS bin, code, predicted FROM obs, q) SELECT CAST(bin AS INTEGER) AS bin, count(*) AS n, round(avg(CASE WHEN code = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM b GROUP BY bin")
def accuracy_by_budget_decile(spark, d):
    ok = F.coalesce(F.col("code") == F.col("predicted"), F.lit(False))
    return _rounded(metrics.decile_bins(observations(spark, d), "budget").groupBy("bin").agg(F.count("*").alias("n"), metrics.share(ok).alias("accuracy")), "accuracy")


@query(CTE + f", k AS (SELECT {_at('code', 4)} AS t, {_at('predicted', 4)} AS p, list_filter([{_at('lcs_code', 4)}, {_at('rag_code', 4)}, {_at('top2', 4)}], lambda x: x IS NOT NULL) AS v FROM obs), b AS (SELECT *, len(v) AS n, len(list_distinct(v)) AS u FROM k WHERE t IS NOT NULL AND p IS NOT NULL) SELECT CASE WHEN n < 2 THEN 'missing' WHEN u = 1 AND n = 3 THEN '3 of 3' WHEN u = 1 AND n = 2 THEN '2 of 2' WHEN u = 2 AND n = 3 THEN '2 of 3' ELSE 'none' END AS bucket, count(*) AS n, round(avg(CASE WHEN p = t THEN 1.0 ELSE 0.0 END), 6) AS accuracy, round(avg(CASE WHEN list_contains(v, t) THEN 1.0 ELSE 0.0 END), 6) AS one_right FROM b GROUP BY 1")
def source_agreement(spark, d):
    return _rounded(metrics.agreement(observations(spark, d), "code", "predicted", ["lcs_code", "rag_code", "top2"]), "accuracy", "one_right")


@query(CTE + f", e AS (SELECT level, coalesce({_cut('predicted', 1)} = {_cut('code', 1)}, false) AS first, NOT coalesce({_at('predicted', 'level')} = {_at('code', 'level')}, false) AS err FROM obs, {_L} WHERE {_depth('code')} >= level) SELECT level, round(avg(CASE WHEN err THEN 1.0 ELSE 0.0 END) FILTER (WHERE first), 6) AS err_if_right, round(avg(CASE WHEN err THEN 1.0 ELSE 0.0 END) FILTER (WHERE NOT first), 6) AS err_if_wrong, count(*) AS n FROM e GROUP BY level")
def error_cascade(spark, d):
    return _rounded(metrics.cascade_errors(observations(spark, d), "code", "predicted", _LEVELS), "err_if_right", "err_if_wrong")


@query(CTE + f", e AS (SELECT level, source, shop_type, annee, {_result('code', 'predicted', 'level')} AS ok FROM obs, {_L}), u AS (SELECT 'overall' AS slice, '' AS value, level, ok FROM e UNION ALL SELECT 'source', coalesce(source, 'N/A'), level, ok FROM e UNION ALL SELECT 'shop_type', coalesce(shop_type, 'N/A'), level, ok FROM e UNION ALL SELECT 'annee', coalesce(CAST(annee AS VARCHAR), 'N/A'), level, ok FROM e) SELECT slice, value, level, count(*) AS n, round(avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM u WHERE ok IS NOT NULL GROUP BY slice, value, level")
def sliced_accuracy(spark, d):
    return _rounded(metrics.sliced_report(observations(spark, d), "code", "predicted", ["source", "shop_type", "annee"], _LEVELS), "accuracy")


_RATES = CTE + ", r AS (SELECT code, count(*) AS n, avg(CASE WHEN predicted = code THEN 1.0 ELSE 0.0 END) AS accuracy FROM obs WHERE code IS NOT NULL GROUP BY code HAVING count(*) >= 10)"


@query(_RATES + " (SELECT code, n, round(accuracy, 6) AS accuracy, 'best' AS side FROM r ORDER BY round(accuracy, 9) DESC, n DESC, code LIMIT 15) UNION ALL (SELECT code, n, round(accuracy, 6), 'worst' FROM r ORDER BY round(accuracy, 9), n DESC, code LIMIT 15)")
def best_and_worst_codes(spark, d):
    return _rounded(metrics.best_and_worst(observations(spark, d), "code", "predicted"), "accuracy")


@query(CTE + f", p AS (SELECT code, {_prefix_sql('code', 'predicted')} AS c FROM obs WHERE length(code) > 0), k AS (SELECT code, c, unnest([2, 4, 6, 8, 10, 12]) AS k FROM p) SELECT k, count(*) AS n, CAST(count(*) FILTER (WHERE length(c) >= least(k, length(code))) AS BIGINT) AS n_ok FROM k GROUP BY k")
def accuracy_by_prefix_length(spark, d):
    rows = observations(spark, d).select("code", codes.common_prefix("code", "predicted").alias("c"))
    return metrics.prefix_accuracy(rows, "code", "c")


@query(CTE + " SELECT CAST(round(confidence * 20) AS INTEGER) AS step, count(*) AS n, round(avg(CASE WHEN code = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM obs GROUP BY 1")
def calibration(spark, d):
    ok = F.coalesce(F.col("code") == F.col("predicted"), F.lit(False))
    return _rounded(observations(spark, d).groupBy(F.round(F.col("confidence") * 20).cast("int").alias("step")).agg(F.count("*").alias("n"), metrics.share(ok).alias("accuracy")), "accuracy")


@query(CTE + f" SELECT {_cut('code', 1)} AS level1, round(sum(budget), 2) AS budget, round(sum(CASE WHEN code = predicted THEN budget ELSE 0 END) / sum(budget), 6) AS weighted_accuracy FROM obs WHERE code IS NOT NULL GROUP BY 1")
def budget_weighted_accuracy(spark, d):
    rows = observations(spark, d).where("code IS NOT NULL").groupBy(codes.truncate_code("code", 1).alias("level1"))
    good = F.sum(F.when(F.col("code") == F.col("predicted"), F.col("budget")).otherwise(F.lit(0.0)))
    return rows.agg(F.round(F.sum("budget"), 2).alias("budget"), F.round(good / F.sum("budget"), 6).alias("weighted_accuracy"))


@query(CTE + " SELECT count(*) AS n, CAST(count(*) FILTER (WHERE starts_with(code, '98') OR starts_with(code, '99')) AS BIGINT) AS n_technical, round(avg(CASE WHEN code = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(DISTINCT code) AS n_codes, " + ", ".join(f"count(DISTINCT {_at('code', k)}) AS classes{k}" for k in _LEVELS) + " FROM obs")
def key_figures(spark, d):
    ok = F.coalesce(F.col("code") == F.col("predicted"), F.lit(False))
    return observations(spark, d).agg(F.count("*").alias("n"), F.count_if(codes.is_technical("code")).alias("n_technical"), F.round(metrics.share(ok), 6).alias("accuracy"), F.count_distinct("code").alias("n_codes"), *[F.count_distinct(codes.at_level("code", k)).alias(f"classes{k}") for k in _LEVELS])


# ---- training sets

_DRAW = "md5('42|' || id)"


@query(CTE + f", r AS (SELECT id, code, row_number() OVER (PARTITION BY code ORDER BY CASE WHEN source = 'F' THEN 0 ELSE 1 END, {_DRAW}, id) AS rn FROM obs WHERE code IS NOT NULL) SELECT id, code FROM r WHERE rn <= 3")
def balanced_training_set(spark, d):
    return training.balance(observations(spark, d).where("code IS NOT NULL").select("id", "code", "source"), "code", F.col("source") == "F", "id", 3).select("id", "code")


@query(CTE + f" SELECT id, CASE WHEN CAST('0x' || left({_DRAW}, 8) AS BIGINT) % 100 < 50 THEN 'test' ELSE 'train' END AS part FROM obs")
def hash_split(spark, d):
    return training.split(observations(spark, d).select("id"), "id")


@query(CTE + f" SELECT id, CASE WHEN row_number() OVER (PARTITION BY code ORDER BY {_DRAW}, id) <= ceil(count(*) OVER (PARTITION BY code) * 20 / 100) THEN 'test' ELSE 'train' END AS part FROM obs")
def stratified_hash_split(spark, d):
    return training.stratified_split(observations(spark, d).select("id", "code"), "code", "id").select("id", "part")


@query(CTE + ", c AS (SELECT code, count(*) AS n FROM obs WHERE code IS NOT NULL GROUP BY code) SELECT code, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight FROM c")
def class_weights(spark, d):
    return _rounded(training.class_weights(observations(spark, d), "code"), "weight")


@query(CTE + " SELECT id, code FROM obs WHERE code IN (SELECT code FROM obs GROUP BY code HAVING count(*) >= 20)")
def supported_classes(spark, d):
    return training.supported(observations(spark, d).select("id", "code"), "code", 20)


# ---- vectors and pages


@query("WITH q AS (SELECT vec_id AS query_id, embedding AS q FROM embeddings WHERE vec_id % 100 = 0), s AS (SELECT query_id, vec_id, list_cosine_similarity(CAST(q AS DOUBLE[]), CAST(embedding AS DOUBLE[])) AS score FROM q JOIN embeddings ON vec_id <> query_id), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, vec_id) AS rank FROM s) SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, round(score, 6) AS score FROM r WHERE rank <= 10")
def cosine_neighbours(spark, d):
    table = spark.read.parquet(f"{d}/embeddings.parquet")
    return _rounded(vectors.cosine_top_k(table, table.where("vec_id % 100 = 0")).select("query_id", "rank", "vec_id", "score"), "score")


@query()
def page_texts(spark, d):
    return readers.page_texts(spark.read.parquet(f"{d}/pages.parquet"))


# ---- documents and prompts


def _notices(spark, d) -> DataFrame:
    return _tree(spark, d).select("code", F.concat(F.lit("label of "), "code").alias("label"))


_NOTICES = _TREE + ", notices AS (SELECT code, 'label of ' || code AS label FROM tree)"


@query(_NOTICES + f", up AS (SELECT n.code, i, {_cut('n.code', 'i')} AS above FROM (SELECT code, unnest(range(1, {_depth('code')})) AS i FROM notices) n) SELECT n.code, CASE WHEN {_depth('n.code')} = 1 THEN NULL ELSE (SELECT string_agg('label of ' || above, ' > ' ORDER BY i) FROM up WHERE up.code = n.code) END AS path FROM notices n")
def ancestor_label_paths(spark, d):
    return documents.ancestor_paths(_notices(spark, d)).select("code", "path")


@query(_NOTICES + " SELECT code, code || ' - ' || label || chr(10) || chr(10) || 'Contains: things' AS text FROM notices")
def notice_documents(spark, d):
    rows = _notices(spark, d).withColumns({"content": F.lit("things"), "exclusions": F.lit(""), "path": F.lit(None).cast("string")})
    return rows.select("code", documents.notice_text("with_exclusions").alias("text"))


@query(_NOTICES + " SELECT string_agg(code || ' — ' || label, chr(10) ORDER BY code) AS block FROM notices")
def nomenclature_text(spark, d):
    return documents.nomenclature_block(_notices(spark, d))


@query(_NOTICES + f", obs3 AS (SELECT id, [predicted, lcs_code, rag_code] AS known FROM obs), p AS (SELECT DISTINCT known, unnest(known) AS c FROM obs3), q AS (SELECT known, c FROM p WHERE c IS NOT NULL), near AS (SELECT DISTINCT known, code FROM q JOIN notices ON {_cut('c', 1)} = {_cut('code', 1)} AND ({_depth('code')} <= 2 OR ({_depth('c')} >= 2 AND starts_with(code, {_cut('c', 2)})))), g AS (SELECT known, count(*) AS n_codes, md5(string_agg(code, chr(10) ORDER BY code)) AS codes_md5 FROM near GROUP BY known), w AS (SELECT count(*) AS n_codes, md5(string_agg(code, chr(10) ORDER BY code)) AS codes_md5 FROM notices) SELECT id, coalesce(g.n_codes, w.n_codes) AS n_codes, coalesce(g.codes_md5, w.codes_md5) AS codes_md5 FROM obs3 LEFT JOIN g ON obs3.known IS NOT DISTINCT FROM g.known, w")
def relevant_nomenclature(spark, d):
    chosen = documents.relevant_codes(observations(spark, d), _notices(spark, d), ["predicted", "lcs_code", "rag_code"])
    return chosen.select("id", F.size("codes").cast("long").alias("n_codes"), F.md5(F.array_join("codes", "\n")).alias("codes_md5"))


@query(CTE + " SELECT id, md5('Product: ' || label || CASE WHEN length(shop) > 0 THEN chr(10) || 'Shop: ' || shop ELSE '' END || CASE WHEN coalesce(budget, 0) <> 0 THEN chr(10) || 'Price: ' || printf('%.2f', budget) || ' euros' ELSE '' END || chr(10) || 'Candidates: ' || top3) AS prompt_md5 FROM obs WHERE label IS NOT NULL AND top3 IS NOT NULL")
def judge_prompts(spark, d):
    rows = observations(spark, d).where("label IS NOT NULL AND top3 IS NOT NULL").withColumn("candidates", F.array("top3"))
    return rows.select("id", F.md5(documents.judge_prompt("label", "shop", "budget", "candidates")).alias("prompt_md5"))


@query(CTE + " SELECT id, code AS first, CASE WHEN num % 2 = 0 THEN top3 END AS second, CAST(NULL AS VARCHAR) AS third FROM obs WHERE code IS NOT NULL AND top3 IS NOT NULL")
def aligned_list_answers(spark, d):
    rows = observations(spark, d).where("code IS NOT NULL AND top3 IS NOT NULL")
    listed = F.when(F.col("num") % 2 == 0, F.to_json(F.array("code", "top3"))).otherwise(F.to_json(F.array("code")))
    answer = F.concat(F.lit("```json\n"), listed, F.lit("\n```"))
    return rows.select("id", documents.aligned_codes(answer, 3).alias("c")).select("id", F.col("c")[0].alias("first"), F.col("c")[1].alias("second"), F.col("c")[2].alias("third"))


# ---- more reports


@query(CTE + " SELECT code, count(*) AS n, round_even(100.0::DOUBLE * count(*) FILTER (WHERE code = predicted) / count(*), 0) AS percent_right FROM obs WHERE code IS NOT NULL GROUP BY code")
def percent_right_by_code(spark, d):
    hits, n = F.count_if(F.col("code") == F.col("predicted")), F.count("*")
    return observations(spark, d).where("code IS NOT NULL").groupBy("code").agg(n.alias("n"), F.bround(100.0 * hits / n, 0).alias("percent_right"))


@query(CTE + f", e AS (SELECT {_cut('code', 1)} AS level1, {_SEVERITY} AS severity, confidence, source, code, predicted FROM obs WHERE NOT (starts_with(code, '98') OR starts_with(code, '99'))) SELECT level1, count(*) AS n, round(avg(confidence), 6) AS mean_confidence FROM e WHERE severity IN ('far-miss', 'near-miss') AND confidence BETWEEN 0.2 AND 0.9 AND source IN ('F', 'O') AND code LIKE '0%' GROUP BY level1")
def filtered_error_panel(spark, d):
    rows = observations(spark, d).where(~codes.is_technical("code")).withColumn("severity", codes.severity("code", "predicted"))
    kept = rows.where(F.col("severity").isin("far-miss", "near-miss") & F.col("confidence").between(0.2, 0.9) & F.col("source").isin("F", "O") & F.col("code").like("0%"))
    return _rounded(kept.groupBy(codes.truncate_code("code", 1).alias("level1")).agg(F.count("*").alias("n"), F.avg("confidence").alias("mean_confidence")), "mean_confidence")


@query(CTE + " SELECT coalesce(shop_type, 'N/A') AS shop_type, CASE WHEN label IS NULL THEN -1 ELSE CAST(least(floor(length(label) / 10), 3) AS INTEGER) END AS length_class, count(*) AS n, round(avg(confidence), 6) AS mean_confidence, round(avg(CASE WHEN code = predicted THEN 0.0 ELSE 1.0 END), 6) AS error_rate FROM obs GROUP BY 1, 2")
def errors_by_label_length(spark, d):
    rows = observations(spark, d).groupBy(F.coalesce("shop_type", F.lit("N/A")).alias("shop_type"), F.when(F.col("label").isNull(), F.lit(-1)).otherwise(F.least(F.floor(F.length("label") / 10), F.lit(3))).cast("int").alias("length_class"))
    wrong = F.avg(F.when(F.col("code") == F.col("predicted"), 0.0).otherwise(1.0))
    return _rounded(rows.agg(F.count("*").alias("n"), F.avg("confidence").alias("mean_confidence"), wrong.alias("error_rate")), "mean_confidence", "error_rate")


_THRESHOLDS = CTE + f", s AS (SELECT code, confidence, {_prefix_sql('code', 'predicted')} = code AS ok FROM obs), t AS (SELECT unnest(range(0, 100)) / 100.0 AS threshold)"


@query(_THRESHOLDS + " SELECT CAST(threshold AS DOUBLE) AS threshold, CAST(count(*) FILTER (WHERE confidence >= threshold AND ok) AS BIGINT) AS n_right, CAST(count(*) FILTER (WHERE confidence >= threshold AND NOT coalesce(ok, false)) AS BIGINT) AS n_wrong FROM s, t GROUP BY threshold")
def threshold_sweep(spark, d):
    ok = F.coalesce(codes.common_prefix("code", "predicted") == F.col("code"), F.lit(False))
    by_reach = observations(spark, d).groupBy(metrics.thresholds_reached("confidence", 100, 100).alias("reach")).agg(F.count_if(ok).alias("r"), F.count_if(~ok).alias("w"))
    each = by_reach.select("*", F.explode(F.sequence(F.lit(0), F.lit(99))).alias("i")).withColumn("threshold", F.col("i") / 100)
    above = lambda c: F.sum(F.when(F.col("i") < F.col("reach"), F.col(c)).otherwise(0))
    return each.groupBy("threshold").agg(above("r").alias("n_right"), above("w").alias("n_wrong"))


@query(CTE + ", m AS (SELECT id, 'predicted' AS method, predicted AS code FROM obs UNION ALL SELECT id, 'lcs_code', lcs_code FROM obs UNION ALL SELECT id, 'rag_code', rag_code FROM obs) SELECT method, count(*) AS n, count(code) AS n_known, count(DISTINCT code) AS n_codes FROM m GROUP BY method")
def methods_long_form(spark, d):
    long = observations(spark, d).unpivot("id", ["predicted", "lcs_code", "rag_code"], "method", "code")
    return long.groupBy("method").agg(F.count("*").alias("n"), F.count("code").alias("n_known"), F.count_distinct("code").alias("n_codes"))


# ---- classifiers: trained models, so their rows alone are checked here and their accuracy in the tests


def _targets(spark, d) -> DataFrame:
    """Labels with the code that the rules give them; explode of one element, so that no later use repeats all rules."""
    rows = observations(spark, d).where("label IS NOT NULL")
    return rows.select("id", "label", F.explode(F.array(rules.rule_code("label"))).alias("target"))


@query()
def flat_classifier(spark, d):
    rows = _targets(spark, d)
    model = classifiers.fit_flat(training.split(rows, "id").where("part = 'train'"), classifiers.char_ngrams("label"), "target")
    return model.predict(rows.select("id", "label"), classifiers.char_ngrams("label"), 3).select("id", F.posexplode("predictions").alias("rank", "p")).select("id", "rank", "p.code", "p.confidence")


@query()
def beam_search(spark, d):
    rows = _targets(spark, d)
    model = classifiers.fit_cascade(training.split(rows, "id").where("part = 'train'").select("id", "label", "target"), "label", "target", 3, forcing=0.8)
    return model.beams(rows.select("id", "label"), "id", 3)


@query()
def heads_classifier(spark, d):
    rows = _targets(spark, d)
    model = classifiers.fit_heads(training.split(rows, "id").where("part = 'train'").select("id", "label", "target"), "label", "target", 2)
    return model.predict(rows.select("id", "label")).drop("label")


@query()
def cascade_classifier(spark, d):
    rows = _targets(spark, d)
    model = classifiers.fit_cascade(training.split(rows, "id").where("part = 'train'"), "label", "target", 3)
    return model.predict(rows.select("id", "label"), 0.3).select("id", F.col("code"), "level", "confidence")
