"""More queries of the registry: evaluation reports, prediction shapes, answers, nomenclature look-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from codalith.functions import codes, text
from codalith.operators import hierarchy, ingest, metrics, predictions, reports, similarity
from codalith.plans.catalog import _LCS_CTE, _LEVELS, _SEVERITY, _TREE, STOPWORDS, _at, _cut, _L, _notices, _pairs, _retrieval, _rounded, _tree, query
from codalith.plans.catalog import _KIDS, _MAPPING, _RAG, _RAG_OUT
from codalith.plans.observations import CTE, observations

_OK = "coalesce(code = predicted, false)"
_EDGES = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]
_BINS = [f"{a}-{b}" for a, b in zip(_EDGES, _EDGES[1:])]


def _one(ok: str) -> str:
    return f"CASE WHEN {ok} THEN 1.0 ELSE 0.0 END"


def _truth(df):
    return F.coalesce(F.col("code") == F.col("predicted"), F.lit(False))


# ---- reports

_BIN = "CASE " + " ".join(f"WHEN confidence {'>=' if a == 0 else '>'} {a} AND confidence <= {b} THEN '{n}'" for a, b, n in zip(_EDGES, _EDGES[1:], _BINS)) + " END"


@query(CTE + f", b AS (SELECT {_BIN} AS bin, confidence, {_OK} AS ok FROM obs) SELECT bin, count(*) AS n, round(avg({_one('ok')}), 6) AS accuracy, round(avg(confidence), 6) AS mean_confidence, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM b WHERE bin IS NOT NULL GROUP BY bin")
def accuracy_by_confidence_bin(spark, d):
    rows = observations(spark, d)
    return _rounded(reports.confidence_bins(rows, "confidence", _truth(rows), _EDGES, _BINS), "accuracy", "mean_confidence", "share")


@query(CTE + f", s AS (SELECT {_SEVERITY} AS severity, confidence FROM obs) SELECT k AS severity, count(s.severity) AS n, round(avg(confidence), 6) AS mean_confidence FROM (SELECT unnest({list(reports.SEVERITIES)}) AS k) LEFT JOIN s ON k = severity GROUP BY k")
def severity_in_fixed_order(spark, d):
    return _rounded(reports.severity_counts(observations(spark, d), "code", "predicted", "confidence"), "mean_confidence")


@query(CTE + f", s AS (SELECT code, predicted, {_OK} AS ok FROM obs WHERE confidence >= 0.9), e AS (SELECT round(avg({_one('NOT ok')}), 6) AS error_share FROM s), p AS (SELECT code || ' -> ' || predicted AS pair, count(*) AS n FROM s WHERE code <> predicted GROUP BY 1) SELECT pair, n, error_share FROM p, e ORDER BY n DESC, pair LIMIT 10")
def high_confidence_errors(spark, d):
    return _rounded(reports.confident_errors(observations(spark, d), "code", "predicted", "confidence", 0.9), "error_share")


@query(CTE + f", top AS (SELECT coalesce(shop, 'N/A') AS value FROM obs GROUP BY 1 ORDER BY count(*) DESC, value LIMIT 15), e AS (SELECT coalesce(shop, 'N/A') AS value, level, {_at('code', 'level')} AS t, {_at('predicted', 'level')} AS p FROM obs, {_L}) SELECT value, level, count(*) AS volume, count(t) AS n, round(avg(CASE WHEN t IS NOT NULL THEN {_one('coalesce(t = p, false)')} END), 6) AS accuracy FROM e WHERE value IN (SELECT value FROM top) GROUP BY value, level HAVING count(t) > 0")
def shop_level_heat_map(spark, d):
    return _rounded(reports.heat_map(observations(spark, d), "code", "predicted", "shop", _LEVELS), "accuracy")


_RANKS = f"SELECT *, {_at('code', 'level')} AS t, {_at('predicted', 'level')} AS p1, {_at('top2', 'level')} AS p2, {_at('top3', 'level')} AS p3 FROM obs, {_L}"


@query(CTE + f", r AS ({_RANKS}), f AS (SELECT 'confident' AS flag, coalesce(confidence >= 0.5, false) AS value, * FROM r UNION ALL SELECT 'has_shop', shop IS NOT NULL, * FROM r), k AS (SELECT flag, value, level, 1 AS k, t, p1, coalesce(t = p1, false) AS hit FROM f UNION ALL SELECT flag, value, level, 3, t, p1, coalesce(t = p1, false) OR coalesce(t = p2, false) OR coalesce(t = p3, false) FROM f) SELECT flag, value, level, k, count(*) AS n, round(avg({_one('hit')}), 6) AS accuracy FROM k WHERE t IS NOT NULL AND p1 IS NOT NULL GROUP BY flag, value, level, k")
def top_k_by_flag(spark, d):
    flags = {"confident": F.col("confidence") >= 0.5, "has_shop": F.col("shop").isNotNull()}
    return _rounded(reports.accuracy_by_flags(observations(spark, d), "code", ["predicted", "top2", "top3"], flags, _LEVELS, [1, 3]), "accuracy")


@query(CTE + f", r AS ({_RANKS}) SELECT {_cut('code', 1)} AS \"group\", level, count(*) AS n, round(avg({_one('coalesce(t = p1, false) OR coalesce(t = p2, false)')}), 6) AS accuracy FROM r WHERE level <> 1 AND t IS NOT NULL AND p1 IS NOT NULL GROUP BY 1, 2")
def top_k_within_first_level(spark, d):
    return _rounded(reports.top_k_within(observations(spark, d), "code", ["predicted", "top2"], 1, _LEVELS, 2), "accuracy")


_SCORED = CTE + f", r AS (SELECT level, confidence, {_at('code', 'level')} AS t, {_at('predicted', 'level')} AS p FROM obs, {_L}), v AS (SELECT * FROM r WHERE t IS NOT NULL AND p IS NOT NULL), w AS (SELECT level, count(*) AS total FROM v GROUP BY level), h AS (SELECT level, threshold, t, p FROM v, (SELECT unnest([0.0, 0.5, 0.9])::DOUBLE AS threshold) WHERE confidence >= threshold), s AS (SELECT level, threshold, class, count(*) FILTER (WHERE t = class) AS support, count(*) FILTER (WHERE p = class) AS guessed, count(*) FILTER (WHERE t = class AND p = class) AS hits FROM (SELECT level, threshold, t, p, unnest(list_distinct([t, p])) AS class FROM h) GROUP BY ALL), f AS (SELECT *, 2.0::DOUBLE * hits / (support + guessed) AS f1 FROM s)"


@query(_SCORED + " SELECT level, threshold, CAST(sum(support) AS BIGINT) AS n, round(sum(hits) / sum(support), 6) AS accuracy, round(avg(f1), 6) AS macro_f1, round(sum(f1 * support) / sum(support), 6) AS weighted_f1, round(sum(support) / any_value(total), 6) AS coverage FROM f JOIN w USING (level) GROUP BY level, threshold")
def scores_by_level_and_threshold(spark, d):
    out = reports.scores_by_threshold(observations(spark, d), "code", "predicted", "confidence", _LEVELS, [0.0, 0.5, 0.9])
    return _rounded(out, "accuracy", "macro_f1", "weighted_f1", "coverage")


@query(_RAG + f", m AS (SELECT filter, level, {_RAG_OUT} FROM e GROUP BY filter, level) SELECT filter, level, round(1 - accuracy, 5) AS error, round(CASE WHEN accuracy < 1 THEN (1 - retrieval_accuracy) / (1 - accuracy) ELSE 0 END, 4) AS retrieval_share, round(CASE WHEN accuracy < 1 THEN retrieval_accuracy * (1 - generation_accuracy) / (1 - accuracy) ELSE 0 END, 4) AS generation_share FROM m")
def error_source_shares(spark, d):
    out = reports.error_sources(_retrieval(spark, d))
    return out.select("filter", "level", F.round("error", 5).alias("error"), F.round("retrieval_share", 4).alias("retrieval_share"), F.round("generation_share", 4).alias("generation_share"))


@query(CTE + ", r AS (SELECT source, code = lcs_code AS ok FROM obs) SELECT source, CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS n_right, CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS n_wrong, CAST(count(*) FILTER (WHERE ok IS NULL) AS BIGINT) AS n_unknown FROM r GROUP BY source HAVING count(*) FILTER (WHERE ok) > 0 AND count(*) FILTER (WHERE NOT ok) > 0 AND count(*) FILTER (WHERE ok IS NULL) > 0")
def recap_by_origin(spark, d):
    return reports.origin_recap(observations(spark, d), "source", F.col("code") == F.col("lcs_code"))


@query(_LCS_CTE + ", r AS (SELECT s1, rank() OVER (PARTITION BY s1 ORDER BY distance) AS rk FROM pairs), n AS (SELECT s1, count(*) AS n_ties FROM r WHERE rk = 1 GROUP BY s1) SELECT n_ties, count(*) AS n_keys FROM n GROUP BY n_ties")
def nearest_ties_histogram(spark, d):
    return reports.ties_histogram(similarity.nearest_ties(_pairs(spark, d)).select("s1"), "s1")


@query(CTE + f", m AS (SELECT coalesce(source, 'N/A') AS s, count(*) AS n, avg({_one(_OK)}) AS accuracy FROM obs GROUP BY 1) SELECT 'accuracy.' || s AS metric, round(accuracy, 6) AS value FROM (SELECT s, accuracy FROM m) UNION ALL SELECT 'n.' || s, n::DOUBLE FROM m")
def flat_metric_rows(spark, d):
    rows = observations(spark, d)
    grouped = rows.groupBy(F.col("source").alias("s")).agg(F.count("*").alias("n"), metrics.share(_truth(rows)).alias("accuracy"))
    flat = reports.flat_metrics(grouped, ["s"], ["n", "accuracy"])
    # Trackers sort by name, so the value's name goes first here.
    name = F.split("metric", "\\.")
    return flat.select(F.concat_ws(".", name[1], name[0]).alias("metric"), F.round("value", 6).alias("value"))


@query(CTE + f" SELECT id, confidence FROM obs WHERE NOT coalesce({_cut('code', 1)} IN ('98', '99'), false) AND source IN ('F', 'O') AND annee IN (1995, 1996, 1997) AND confidence >= 0.3 AND {_SEVERITY} IN ('far-miss', 'correct') AND starts_with(code, '0') AND contains(lower(label), 'bio')")
def dynamic_filters(spark, d):
    rows = reports.where_all(observations(spark, d), technical=False, sources=["F", "O"], years=[1995, 1996, 1997], min_confidence=0.3, severities=["far-miss", "correct"], prefix="0", contains="BIO")
    return rows.select("id", "confidence")


@query(CTE + f" SELECT shop_type, count(*) AS n, round(avg({_one(_OK)}), 6) AS accuracy, round(sum(budget), 2) AS budget, round(sum(CASE WHEN {_OK} THEN budget ELSE 0 END) / sum(budget), 6) AS weighted_accuracy FROM obs GROUP BY shop_type")
def budget_by_shop_type(spark, d):
    out = reports.several_right(observations(spark, d), "code", "predicted", "budget", "shop_type")
    return _rounded(out.withColumn("budget", F.round("budget", 2)), "accuracy", "weighted_accuracy")


# ---- shapes of predictions


def _nested(spark, d):
    """A map from level to ranked (code, confidence), as hierarchical models give it."""
    rows = observations(spark, d)
    item = lambda c, k, p: F.when(codes.at_level(c, k).isNotNull(), F.struct(codes.at_level(c, k).alias("code"), (F.col("confidence") * p).alias("confidence")))
    ranked = lambda k: F.array_compact(F.array(item("predicted", k, 1.0), item("top2", k, 0.5)))
    return rows.select("id", F.create_map(F.lit("level1"), ranked(1), F.lit("level3"), ranked(3)).alias("all_levels"))


def _wide_sql(k: int) -> str:
    p, q = _at("predicted", k), _at("top2", k)
    both = f"({p} IS NOT NULL AND {q} IS NOT NULL)"
    first, sure = f"coalesce({p}, {q}, '')", f"CASE WHEN {p} IS NOT NULL THEN confidence WHEN {q} IS NOT NULL THEN confidence * 0.5 ELSE 0.0 END"
    return f"{first} AS predicted_level{k}, round({sure}, 6) AS confidence_level{k}, CASE WHEN {both} THEN {q} ELSE '' END AS predicted_level{k}_top2, round(CASE WHEN {both} THEN confidence * 0.5 ELSE 0.0 END, 6) AS confidence_level{k}_top2"


@query(CTE + f" SELECT id, {_wide_sql(1)}, {_wide_sql(3)} FROM obs")
def predictions_in_columns(spark, d):
    wide = predictions.wide_predictions(_nested(spark, d), "all_levels", [1, 3], top_k=2)
    return _rounded(wide, *[c for c in wide.columns if c.startswith("confidence")])


@query(_TREE + _KIDS + _MAPPING + f", f AS (SELECT id, coalesce(a.code_parent_equivalent, {_cut('obs.code', 3)}) AS code_cut, coalesce(b.code_parent_equivalent, {_cut('predicted', 3)}) AS predicted_cut, coalesce(c.code_parent_equivalent, {_cut('top2', 3)}) AS retrieved1, coalesce(e.code_parent_equivalent, {_cut('top3', 3)}) AS retrieved2 FROM obs LEFT JOIN mapping a ON a.code = {_cut('obs.code', 3)} LEFT JOIN mapping b ON b.code = {_cut('predicted', 3)} LEFT JOIN mapping c ON c.code = {_cut('top2', 3)} LEFT JOIN mapping e ON e.code = {_cut('top3', 3)}) SELECT * FROM f")
def pruned_evaluation_frame(spark, d):
    rows = observations(spark, d)
    predicted = rows.select("id", "predicted", F.array("top2", "top3").alias("retrieved"), F.lit("stale").alias("code"))
    out = predictions.evaluation_frame(predicted, rows.select("id", "code"), hierarchy.prune_mapping(_tree(spark, d)), level=3)
    return out.select("id", "code_cut", "predicted_cut", F.col("retrieved_cut")[0].alias("retrieved1"), F.col("retrieved_cut")[1].alias("retrieved2"))


@query(_TREE + " SELECT id, predicted, CASE WHEN predicted IS NULL THEN NULL WHEN predicted IN (SELECT code FROM tree) THEN 'label of ' || predicted ELSE predicted END AS label FROM obs")
def labels_of_predictions(spark, d):
    return predictions.with_label(observations(spark, d).select("id", "predicted"), _notices(spark, d), "predicted", "label")


@query(CTE + " SELECT id, CASE WHEN starts_with(code, '99') THEN coalesce(rag_code, code) ELSE code END AS routed, CASE WHEN length(code) > 0 THEN CASE WHEN string_split(code, '.')[1] IN ('98', '99') THEN string_split(code, '.')[1] ELSE 'standard' END END AS kind FROM obs")
def routed_technical_codes(spark, d):
    return observations(spark, d).select("id", predictions.routed_code("code", "rag_code").alias("routed"), predictions.code_kind("code").alias("kind"))


_DECIDED = "CASE num % 6 WHEN 0 THEN 'no idea' WHEN 1 THEN '{\"confiance\": 3}' WHEN 2 THEN '{\"code\": \"' || c || '\"}' WHEN 3 THEN '{\"code\": \"' || c || '\", \"confiance\": 7}' WHEN 4 THEN '{\"code\": \"' || c || '\", \"confiance\": 4, \"justification\": \"' || repeat('x', 501) || '\"}' ELSE '{\"code\": \"' || c || '\", \"confiance\": 5, \"codable\": true}' END"


@query(CTE + ", a AS (SELECT id, num % 6 AS m, coalesce(predicted, '') AS c FROM obs) SELECT id, CASE WHEN m = 5 AND c <> '' THEN c END AS code, CASE m WHEN 0 THEN 'not JSON' WHEN 1 THEN 'no code' ELSE CASE WHEN c = '' THEN 'no code' ELSE CASE m WHEN 2 THEN 'no confidence' WHEN 3 THEN 'confidence outside 1 to 5' WHEN 4 THEN 'reason too long' END END END AS error FROM a")
def checked_decisions(spark, d):
    answers = observations(spark, d).withColumn("c", F.coalesce("predicted", F.lit(""))).select("id", F.expr(_DECIDED).alias("json"))
    checked = answers.select("id", predictions.checked_decision(F.col("json")).alias("x"))
    return checked.select("id", F.col("x.decision.code").alias("code"), F.col("x.error").alias("error"))


@query(CTE + " SELECT id, 'A:' || upper(label) AS answer, CAST(NULL AS VARCHAR) AS error FROM obs WHERE label IS NOT NULL")
def answers_of_a_client(spark, d):
    rows = observations(spark, d).where("label IS NOT NULL")
    return predictions.map_with_client(rows, "label", lambda: lambda texts: ["A:" + t.upper() for t in texts])


# ---- nomenclature and labels

@query(CTE + f", d AS (SELECT DISTINCT shop_type AS value FROM obs WHERE shop_type IS NOT NULL) SELECT value, count(*) AS n, {', '.join(f'''round(avg(CASE WHEN {_at('code', k)} IS NOT NULL THEN {_one(f'coalesce({_at("code", k)} = {_at("predicted", k)}, false)')} END), 6) AS level{k}''' for k in _LEVELS)} FROM d JOIN obs ON value = shop_type GROUP BY value")
def level_accuracies_wide(spark, d):
    rows = observations(spark, d).where("shop_type IS NOT NULL").groupBy(F.col("shop_type").alias("value"))
    return rows.agg(F.count("*").alias("n"), *[F.round(metrics.share(reports._level_right("code", "predicted", k)), 6).alias(f"level{k}") for k in _LEVELS])


@query("SELECT DISTINCT n_name AS name FROM nation UNION SELECT r_name FROM region")
def distinct_names(spark, d):
    parts = [spark.read.parquet(f"{d}/{t}.parquet").select(F.col(c).alias("name")) for t, c in (("nation", "n_name"), ("region", "r_name"))]
    return ingest.stack(parts).distinct()


@query("SELECT p_partkey, array_to_string(list_filter(list_filter(string_split(regexp_replace(lower(p_name), '[0-9]', ' ', 'g'), ' '), lambda x: length(x) > 1), lambda x: NOT list_contains(" + str(STOPWORDS) + ", x)), ' ') AS cleaned FROM part")
def strong_clean_names(spark, d):
    return spark.read.parquet(f"{d}/part.parquet").select("p_partkey", text.strong_clean("p_name", STOPWORDS).alias("cleaned"))
