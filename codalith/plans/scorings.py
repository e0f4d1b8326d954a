"""Queries of the registry on full evaluations, selections and look-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from codalith.functions import codes, text
from codalith.operators import classifiers, documents, ingest, metrics, scores, selection, similarity
from codalith.plans.catalog import _LCS_CTE, _LEVELS, _NOTICES, _at, _cut, _depth, _L, _notices, _pairs, _rounded, query
from codalith.plans.evaluations import _OK, _one, _truth
from codalith.plans.observations import CTE, observations
from codalith.sources import readers

# ---- evaluation in full

_FILTERS = {"all_raw": "true", "all_parsed": "num % 9 <> 0", "codable_only": "num % 8 <> 0", "parsed_and_codable": "num % 9 <> 0 AND num % 8 <> 0", "threshold": "confidence >= 0.7"}
_FIVE = "(SELECT unnest([1, 2, 3, 4, 5]) AS level)"


def _same(a: str, b: str) -> str:
    return f"coalesce({_cut(a, 'level')} = {_cut(b, 'level')}, false)"


_HIER = CTE + ", f AS (" + " UNION ALL ".join(f"SELECT '{n}' AS filter, * FROM obs WHERE {c}" for n, c in _FILTERS.items()) + f"), e AS (SELECT filter, level, left(label, 4) AS product, {_cut('predicted', 'level')} IS NOT DISTINCT FROM {_cut('code', 'level')} AS ok, {_same('predicted', 'code')} OR {_same('top2', 'code')} OR {_same('top3', 'code')} AS found FROM f, {_FIVE})"
_HIER_OUT = f"count(*) AS n, round(avg({_one('ok')}), 6) AS accuracy, round(avg({_one('found')}), 6) AS retrieval_accuracy, round(coalesce(avg({_one('ok')}) FILTER (WHERE found), 0), 6) AS generation_accuracy"


def _hierarchical(spark, d, by=None):
    rows = observations(spark, d).withColumns({"retrieved": F.array("predicted", "top2", "top3"), "product": F.left("label", F.lit(4))})
    out = metrics.retrieval_accuracy(rows, "code", "predicted", "retrieved", [1, 2, 3, 4, 5], {n: F.expr(c) for n, c in _FILTERS.items()}, by)
    return _rounded(out, "accuracy", "retrieval_accuracy", "generation_accuracy")


@query(_HIER + f" SELECT filter, level, {_HIER_OUT} FROM e GROUP BY filter, level")
def hierarchical_metrics(spark, d):
    return _hierarchical(spark, d)


@query(_HIER + f" SELECT product, filter, level, {_HIER_OUT} FROM e GROUP BY product, filter, level")
def hierarchical_metrics_by_product(spark, d):
    return _hierarchical(spark, d, ["product"])


_SCOPES = {"all": "true", "in_2": "num % 2 = 0", "in_3": "num % 3 = 0", "none": "num % 2 <> 0 AND num % 3 <> 0", "nothing": "num < 0"}
_LIMITS = [0.0, 0.5, 0.95, 2.0]
_AVERAGED = ["accuracy", *[f"{a}_{c}" for a in scores.AVERAGES for c in ("precision", "recall", "f1")], "coverage"]
_CLASS_SQL = "CASE WHEN guessed > 0 THEN hits / guessed ELSE 0 END AS precision, CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall, 2.0::DOUBLE * hits / (support + guessed) AS f1"
_MEANS_SQL = ", ".join([f"round(sum({c} * support) / sum(support), 6) AS weighted_{c}, round(avg({c}), 6) AS macro_{c}" for c in ("precision", "recall", "f1")])
_TABLE = CTE + ", f AS (" + " UNION ALL ".join(f"SELECT '{n}' AS scope, * FROM obs WHERE {c}" for n, c in _SCOPES.items()) + f"), tot AS (SELECT scope, count(*) AS total FROM f GROUP BY scope), r AS (SELECT scope, level, confidence, {_at('code', 'level')} AS t, {_at('predicted', 'level')} AS p FROM f, {_L}), h AS (SELECT scope, level, threshold, t, p FROM r, (SELECT unnest({_LIMITS})::DOUBLE AS threshold) WHERE t IS NOT NULL AND p IS NOT NULL AND confidence >= threshold), s AS (SELECT scope, level, threshold, class, count(*) FILTER (WHERE t = class) AS support, count(*) FILTER (WHERE p = class) AS guessed, count(*) FILTER (WHERE t = class AND p = class) AS hits FROM (SELECT *, unnest(list_distinct([t, p])) AS class FROM h) GROUP BY ALL), c AS (SELECT *, {_CLASS_SQL} FROM s), g AS (SELECT scope, level, threshold, CAST(sum(support) AS BIGINT) AS n, round(sum(hits) / sum(support), 6) AS accuracy, {_MEANS_SQL} FROM c GROUP BY scope, level, threshold), every AS (SELECT scope, level, threshold FROM (SELECT unnest({list(_SCOPES)}) AS scope), {_L}, (SELECT unnest({_LIMITS})::DOUBLE AS threshold))"


@query(_TABLE + " SELECT scope, level, threshold, coalesce(n, 0) AS n, " + ", ".join(_AVERAGED[:-1]) + ", round(coalesce(n / total, 0), 6) AS coverage FROM every LEFT JOIN g USING (scope, level, threshold) LEFT JOIN tot USING (scope)")
def scores_by_scope_level_and_threshold(spark, d):
    out = scores.score_table(observations(spark, d), "code", "predicted", "confidence", _LEVELS, _LIMITS, {n: F.expr(c) for n, c in _SCOPES.items()})
    return _rounded(out, *_AVERAGED)


_SLICES = {"source": "source", "amount": "CASE WHEN budget IS NULL THEN NULL WHEN budget <= 100 THEN '<= 100' ELSE '> 100' END", "store": "shop_type"}
_SLICED = CTE + ", x AS (SELECT 'overall' AS slice, '' AS value, code AS t, predicted AS p1, top2 AS p2, top3 AS p3 FROM obs UNION ALL SELECT 'level', CAST(level AS VARCHAR), " + ", ".join(_at(c, "level") for c in ("code", "predicted", "top2", "top3")) + f" FROM obs, {_L} UNION ALL " + " UNION ALL ".join(f"SELECT '{n}', coalesce({c}, 'N/A'), code, predicted, top2, top3 FROM obs" for n, c in _SLICES.items()) + f"), v AS (SELECT * FROM x WHERE t IS NOT NULL AND p1 IS NOT NULL), s AS (SELECT slice, value, class, count(*) FILTER (WHERE t = class) AS support, count(*) FILTER (WHERE p1 = class) AS guessed, count(*) FILTER (WHERE t = class AND p1 = class) AS hits FROM (SELECT *, unnest(list_distinct([t, p1])) AS class FROM v) GROUP BY ALL), c AS (SELECT *, {_CLASS_SQL} FROM s), f1 AS (SELECT slice, value, round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM c GROUP BY slice, value)"


@query(_SLICED + f" SELECT slice, value, count(*) AS n, round(avg({_one('t = p1')}), 6) AS accuracy, any_value(weighted_f1) AS weighted_f1, round(avg({_one('t = p1 OR coalesce(t = p2, false)')}), 6) AS top2, round(avg({_one('t = p1 OR coalesce(t = p2, false) OR coalesce(t = p3, false)')}), 6) AS top3 FROM v JOIN f1 USING (slice, value) GROUP BY slice, value")
def evaluation_report(spark, d):
    out = scores.slice_report(observations(spark, d), "code", ["predicted", "top2", "top3"], {n: F.expr(c) for n, c in _SLICES.items()}, _LEVELS, 3)
    return _rounded(out, "accuracy", "weighted_f1", "top2", "top3")


@query(CTE + f" SELECT left(code, 4) AS code, CAST(count(*) FILTER (WHERE {_OK}) AS BIGINT) AS n_right, count(*) AS n, round_even(100.0::DOUBLE * count(*) FILTER (WHERE {_OK}) / count(*), 0) AS percent_right FROM obs GROUP BY 1")
def percent_right_by_short_code(spark, d):
    return scores.rate_by_code(observations(spark, d), "code", F.col("code") == F.col("predicted"), 4)


@query(CTE + ", p AS (SELECT CASE WHEN num % 10 <> 0 THEN confidence END AS prop, code = predicted AS ok FROM obs), t AS (SELECT unnest([0.2, 0.8])::DOUBLE AS threshold), c AS (SELECT threshold, CASE WHEN prop IS NOT NULL THEN ok END AS ok, count(*) AS n FROM p, t WHERE prop IS NULL OR prop >= threshold GROUP BY ALL) SELECT *, CAST(sum(n) OVER (PARTITION BY threshold) AS BIGINT) AS total FROM c")
def contingency_by_threshold(spark, d):
    rows = observations(spark, d).withColumn("prop", F.when(F.col("num") % 10 != 0, F.col("confidence")))
    return scores.contingency(rows, F.col("code") == F.col("predicted"), "prop", [0.2, 0.8])


_TENTH = "CAST(least(floor(round(confidence * 10, 9)), 9) AS VARCHAR)"


@query(CTE + ", x AS (" + " UNION ALL ".join(f"SELECT '{n}' AS slice, coalesce({c}, 'N/A') AS value, budget, {_OK} AS ok FROM obs" for n, c in (("level1", _cut("code", 1)), ("source", "source"), ("confidence", f"CAST({_TENTH} AS INTEGER)::VARCHAR"))) + ") SELECT slice, value, round(sum(budget), 2) AS weight, round(sum(CASE WHEN ok THEN budget ELSE 0 END) / sum(budget), 6) AS accuracy FROM x GROUP BY slice, value")
def budget_weighted_slices(spark, d):
    rows = observations(spark, d)
    tenth = F.least(F.floor(F.round(F.col("confidence") * 10, 9)), F.lit(9)).cast("int")
    out = scores.weighted_slices(rows, _truth(rows), "budget", {"level1": codes.truncate_code("code", 1), "source": F.col("source"), "confidence": tenth})
    return out.select("slice", "value", F.round("weight", 2).alias("weight"), F.round("accuracy", 6).alias("accuracy"))


@query(CTE + f", x AS (SELECT level, {_at('code', 'level')} AS c FROM obs, {_L}) SELECT level, count(DISTINCT c) AS classes, count(DISTINCT c) FILTER (WHERE NOT (starts_with(c, '98') OR starts_with(c, '99'))) AS standard_classes FROM x GROUP BY level")
def classes_per_level(spark, d):
    return scores.class_counts(observations(spark, d), "code", _LEVELS)


@query(CTE + f", r AS (SELECT shop, count(*) AS n, avg({_one(_OK)}) AS rate FROM obs WHERE shop IS NOT NULL GROUP BY shop HAVING count(*) >= 20) SELECT CAST(least(floor(round(rate * 10, 9)), 9) AS INTEGER) AS bin, count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_rows FROM r GROUP BY 1")
def shop_accuracy_histogram(spark, d):
    rows = observations(spark, d)
    return scores.rate_histogram(rows, "shop", _truth(rows))


@query(CTE + f" SELECT CAST(least(floor(round(confidence * 50, 9)), 49) AS INTEGER) AS bin, count(*) AS n, round(avg({_one('NOT ' + _OK)}), 6) AS error_rate FROM obs GROUP BY 1")
def error_rate_by_fine_bin(spark, d):
    rows = observations(spark, d)
    fine = F.least(F.floor(F.round(F.col("confidence") * 50, 9)), F.lit(49)).cast("int")
    return _rounded(rows.groupBy(fine.alias("bin")).agg(F.count("*").alias("n"), metrics.share(~_truth(rows)).alias("error_rate")), "error_rate")


@query(CTE + f", x AS (SELECT coalesce(shop, 'N/A') AS value, {_at('code', 2)} AS t, {_at('predicted', 2)} AS p FROM obs) SELECT value, count(*) AS volume, count(t) AS n, count(DISTINCT t) AS classes, round(avg(CASE WHEN t IS NOT NULL THEN {_one('coalesce(t = p, false)')} END), 6) AS accuracy FROM x GROUP BY value ORDER BY volume DESC, value LIMIT 20")
def top_shops(spark, d):
    return _rounded(scores.dimension_panel(observations(spark, d), "code", "predicted", "shop", 2), "accuracy")


_TEN = ["predicted", "top2", "top3", "lcs_code", "rag_code"]


@query(CTE + ", x AS (SELECT k, " + " OR ".join(f"(k >= {i} AND coalesce(code = {c}, false))" for i, c in enumerate(_TEN, 1)) + " AS hit FROM obs, (SELECT unnest(range(1, 11)) AS k) WHERE code IS NOT NULL AND predicted IS NOT NULL) SELECT CAST(k AS INTEGER) AS k, count(*) AS n, " + f"round(avg({_one('hit')}), 6) AS accuracy FROM x GROUP BY k")
def top_ten_hits(spark, d):
    rows = observations(spark, d).where("code IS NOT NULL AND predicted IS NOT NULL").select("code", F.array(*_TEN).alias("p"))
    hits = [metrics.share(F.coalesce(F.array_contains(F.slice("p", 1, k), F.col("code")), F.lit(False))).alias(f"k{k}") for k in range(1, 11)]
    wide = rows.agg(F.count("*").alias("n"), *hits)
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.round(f"k{k}", 6).alias("accuracy")) for k in range(1, 11)])).alias("x")
    return wide.select("n", each).select("x.k", "n", "x.accuracy")


@query(CTE + f" SELECT count(*) AS n, CAST(count(*) FILTER (WHERE NOT {_OK}) AS BIGINT) AS n_errors, round(avg(confidence), 6) AS mean_confidence, round(avg(confidence) FILTER (WHERE NOT {_OK}), 6) AS error_confidence, count(DISTINCT code) FILTER (WHERE NOT {_OK}) AS error_codes FROM obs")
def error_panel_figures(spark, d):
    return _rounded(scores.error_figures(observations(spark, d), "code", "predicted", "confidence"), "mean_confidence", "error_confidence")


_RUN = "CASE WHEN num % 20 = 0 THEN 'timeout' END AS error, num % 700 AS prompt, num % 40 AS completion, CAST(num % 9 AS DOUBLE) / 4 AS seconds"


@query(CTE + f", r AS (SELECT {_RUN} FROM obs) SELECT count(*) AS n, count(error) AS n_errors, CAST(sum(prompt) AS BIGINT) AS prompt_tokens, CAST(sum(completion) AS BIGINT) AS completion_tokens, sum(seconds) AS seconds, CAST(sum(prompt) + sum(completion) AS BIGINT) AS tokens, round(60 * count(*) / sum(seconds), 6) AS per_minute FROM r")
def run_totals(spark, d):
    rows = observations(spark, d).selectExpr("num", *[c.strip() for c in _RUN.split(", ")])
    return _rounded(scores.run_totals(rows, "error", "prompt", "completion", "seconds"), "per_minute")


# ---- selections

_KINDS = "CASE num % 6 " + " ".join(f"WHEN {k} THEN '{name} (centre)'" for k, (name, _) in enumerate(selection.RESTAURANTS)) + " WHEN 4 THEN 'Boulangerie' END"


@query(CTE + f", k AS (SELECT id, {_KINDS} AS kind, lcs_code FROM obs) SELECT id, CASE " + " ".join(f"WHEN contains(kind, '{name}') THEN '{code}'" for name, code in selection.RESTAURANTS) + " ELSE lcs_code END AS code_lcs FROM k")
def restaurant_overrides(spark, d):
    return observations(spark, d).withColumn("kind", F.expr(_KINDS)).select("id", selection.restaurant_code("kind", "lcs_code").alias("code_lcs"))


@query(CTE + " SELECT id, CASE source WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE source END AS source FROM obs")
def recoded_sources(spark, d):
    return observations(spark, d).select("id", selection.recoded("source", {"F": "finished", "O": "open"}).alias("source"))


@query(CTE + f" SELECT id, {_depth('code')} AS depth, CASE WHEN num % 3 = 0 THEN NULL WHEN num % 3 = 1 THEN 'Poste' ELSE 'Classe' END AS type FROM obs WHERE {_depth('code')} <= 3 AND length(code) - length(replace(code, '.', '')) = 1 AND num % 3 <> 1")
def shallow_items(spark, d):
    kind = F.when(F.col("num") % 3 == 1, "Poste").when(F.col("num") % 3 == 2, "Classe")
    rows = observations(spark, d).withColumn("type", kind)
    return rows.where(~F.col("type").eqNullSafe("Poste") & (codes.depth("code") <= 3) & (F.regexp_count("code", F.lit("[.]")) == 1)).select("id", codes.depth("code").alias("depth"), "type")


@query(CTE + " SELECT id, code FROM obs ORDER BY md5('7|' || id), id LIMIT 50")
def random_sample(spark, d):
    return selection.sample_rows(observations(spark, d).select("id", "code"), "id", 50, seed=7)


@query(CTE + f" SELECT id, code, predicted FROM obs WHERE NOT {_OK} AND num % 8 <> 0 AND NOT (starts_with(code, '98') OR starts_with(code, '99')) ORDER BY md5('42|' || id), id LIMIT 40")
def tricky_error_sample(spark, d):
    rows = observations(spark, d).withColumn("codable", F.col("num") % 8 != 0)
    return selection.tricky_errors(rows, "code", "predicted", "codable", "id", 40).select("id", "code", "predicted")


@query(CTE + " SELECT id, code FROM obs WHERE code IN (SELECT predicted FROM obs WHERE source = 'F' AND confidence >= 0.97)")
def rows_of_known_labels(spark, d):
    rows = observations(spark, d)
    return selection.known_labels(rows.select("id", "code"), "code", rows.where("source = 'F' AND confidence >= 0.97").select(F.col("predicted").alias("label")))


@query(CTE + " SELECT id, label, confidence FROM obs WHERE contains(lower(label), 'lait') ORDER BY confidence DESC, id LIMIT 500")
def label_search(spark, d):
    return selection.search(observations(spark, d).select("id", "label", "confidence"), "label", "LAIT", "confidence", "id")


@query(CTE + " SELECT id, code FROM obs WHERE code IN (SELECT DISTINCT code FROM obs WHERE code IS NOT NULL ORDER BY code LIMIT 12)")
def first_categories(spark, d):
    return selection.first_groups(observations(spark, d).select("id", "code"), "code", 12)


@query(CTE + ", r AS (SELECT id, predicted AS llm_code FROM obs WHERE source = 'F' UNION ALL SELECT 'x' || id, NULL FROM obs WHERE code IS NULL) SELECT r.id, label, llm_code FROM obs RIGHT JOIN r ON obs.id = r.id")
def merged_results(spark, d):
    rows = observations(spark, d)
    done = rows.where("source = 'F'").select("id", F.col("predicted").alias("llm_code")).union(rows.where("code IS NULL").select(F.concat(F.lit("x"), "id"), F.lit(None).cast("string")))
    return selection.merged_results(rows.select("id", "label"), done, "id")


@query(CTE + " SELECT id, CAST(least(greatest(floor(confidence * 10), 0), 9) AS INTEGER) AS bucket, CAST(floor(length(label) / 4) AS INTEGER) AS tokens FROM obs")
def buckets_and_tokens(spark, d):
    return observations(spark, d).select("id", selection.confidence_bucket("confidence").alias("bucket"), selection.estimated_tokens("label").alias("tokens"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S+00:00') AS at, strftime(o_orderdate, '%Y%m%d') AS day FROM orders")
def time_stamps(spark, d):
    return spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", selection.iso_utc("o_orderdate").alias("at"), selection.date_stamp("o_orderdate").alias("day"))


@query(CTE + " SELECT code AS label, CAST(row_number() OVER (ORDER BY code) - 1 AS INTEGER) AS number FROM (SELECT DISTINCT code FROM obs WHERE code IS NOT NULL)")
def label_numbers(spark, d):
    return selection.label_numbers(observations(spark, d), "code")


@query("WITH n AS (SELECT DISTINCT trim(n_name) AS s FROM nation), p AS (SELECT a.s AS s1, b.s AS s2 FROM n a, n b WHERE a.s <> b.s), r AS (SELECT s1, s2, i, k, substr(s1, i, k) AS sub FROM (SELECT s1, s2, i, unnest(range(1, length(s1) - i + 2)) AS k FROM (SELECT s1, s2, unnest(range(1, length(s1) + 1)) AS i FROM p))), h AS (SELECT * FROM r WHERE k >= 3 AND contains(upper(s2), upper(sub))) SELECT s1, s2, min_by(sub, (-k) * 1000 + i) AS common_substring FROM h GROUP BY s1, s2")
def spelling_variants(spark, d):
    return selection.spelling_variants(spark.read.parquet(f"{d}/nation.parquet"), "n_name")


# ---- texts

_HEAD = "'**' || code || ': ' || label || '**'"
_BASE = "chr(10) || chr(10) || '**Note générale:** general' || chr(10) || chr(10) || '**Inclusions:** central. more'"
_ABOVE = f"CASE WHEN {_depth('code')} > 1 THEN chr(10) || chr(10) || '**À niveau(x) plus agrégé(s), ce code fait partie des familles de produits suivants :** ' || path ELSE '' END"
_OUT = "CASE WHEN length(code) % 2 = 0 THEN chr(10) || chr(10) || '**Exclusions:** not this' ELSE '' END"
_WAYS = {"code_only": "", "basic": f" || {_BASE}", "with_exclusions": f" || {_BASE} || {_OUT}", "with_hierarchy": f" || {_BASE} || {_ABOVE}", "all_info": f" || {_BASE} || {_ABOVE} || {_OUT}"}


@query(_NOTICES + f", up AS (SELECT code AS below, {_cut('code', 'i')} AS c, i FROM (SELECT code, unnest(range(1, {_depth('code')})) AS i FROM notices)), paths AS (SELECT below AS code, string_agg(c || ': label of ' || c, ' > ' ORDER BY i) AS path FROM up GROUP BY below), n AS (SELECT notices.code, label, path FROM notices LEFT JOIN paths USING (code)) " + " UNION ALL ".join(f"SELECT code, '{s}' AS strategy, md5({_HEAD}{t}) AS text_md5 FROM n" for s, t in _WAYS.items()))
def notices_by_strategy(spark, d):
    rows = documents.with_lineage(_notices(spark, d)).withColumns({"general": F.lit("general"), "central": F.lit(" central"), "additional": F.lit("more "), "exclusions": F.when(F.length("code") % 2 == 0, "not this")})
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("strategy"), F.md5(documents.notice_markdown(s)).alias("text_md5")) for s in documents.STRATEGIES])).alias("x")
    return rows.select("code", each).select("code", "x.*")


@query("SELECT p_partkey, array_to_string(list_filter(list_filter(string_split(regexp_replace(lower('Été ' || p_name || ' 5 €'), '[0-9]', ' ', 'g').replace('été', 'ete').replace('€', 'eur'), ' '), lambda x: length(x) > 1), lambda x: NOT list_contains(['de', 'la'], x)), ' ') AS cleaned FROM part")
def classifier_texts(spark, d):
    named = F.concat(F.lit("Été "), "p_name", F.lit(" 5 €"))
    return spark.read.parquet(f"{d}/part.parquet").select("p_partkey", text.classifier_clean(named, ["de", "la"]).alias("cleaned"))


# ---- ingest

@query(CTE + " SELECT id, count(*) OVER (PARTITION BY label, code) > 1 AS is_duplicate FROM obs")
def duplicate_flags(spark, d):
    return ingest.flag_duplicates(observations(spark, d).select("id", "label", "code"), ["label", "code"]).select("id", "is_duplicate")


@query(CTE + ", r AS (SELECT *, row_number() OVER (PARTITION BY label, code ORDER BY confidence, id) AS rn FROM obs) SELECT id, label, code, confidence FROM r WHERE rn = 1")
def first_of_each_label(spark, d):
    return ingest.keep_first(observations(spark, d).select("id", "label", "code", "confidence"), ["label", "code"], ["confidence", "id"])


@query(CTE + " SELECT code, shop, annee, source, shop_type, round(nullif(sum(coalesce(budget, 0)), 0), 4) AS budget, count(*) AS n_obs FROM obs GROUP BY code, shop, annee, source, shop_type")
def budget_by_five_keys(spark, d):
    return _rounded(ingest.sum_budget(observations(spark, d), ["code", "shop", "annee", "source", "shop_type"], "budget"), "budget", digits=4)


@query(CTE + " SELECT id, " + ", ".join(f"{_at('code', k)} AS level{k}" for k in range(1, 6)) + ", lower(trim(label)) AS text FROM obs WHERE NOT coalesce(starts_with(code, '98') OR starts_with(code, '99'), false)")
def training_set(spark, d):
    rows = observations(spark, d).select("id", "code", F.col("label").alias("product"))
    return readers.load_training_set(rows).drop("code", "product")


@query(CTE + " SELECT id, length(label) AS n_chars, len(list_filter(string_split_regex(trim(label), '\\s+'), lambda w: length(w) > 0)) AS n_words, CASE WHEN label IS NULL THEN 0 ELSE greatest(length(label) + 2 - 2, 0) + greatest(length(label) + 2 - 3, 0) + greatest(length(label) + 2 - 4, 0) END AS n_grams FROM obs WHERE label IS NOT NULL")
def text_sizes(spark, d):
    rows = observations(spark, d).where("label IS NOT NULL")
    n_words = F.size(F.filter(F.split(F.trim("label"), "(?U)\\s+"), lambda w: F.length(w) > 0)).cast("long")
    return rows.select("id", F.length("label").cast("long").alias("n_chars"), n_words.alias("n_words"), F.size(classifiers.char_ngrams("label")).cast("long").alias("n_grams"))


@query(_LCS_CTE + ", every AS (SELECT s1, s2, distance FROM pairs UNION ALL SELECT DISTINCT p_name, p_name, 0.0 FROM part WHERE p_name IN (SELECT p_name FROM part WHERE p_size > 49)), r AS (SELECT *, rank() OVER (PARTITION BY s1 ORDER BY distance) AS rk FROM every) SELECT s1, s2, distance FROM r WHERE rk = 1")
def nearest_with_exact_matches(spark, d):
    names = spark.read.parquet(f"{d}/part.parquet")
    exact = similarity.exact_pairs(names.select(F.col("p_name").alias("s1")), names.where("p_size > 49").select(F.col("p_name").alias("s2")))
    every = _pairs(spark, d).unionByName(exact)
    return _rounded(similarity.nearest_ties(every).select("s1", "s2", "distance"), "distance")


@query("SELECT page_id, i, CASE WHEN NOT regexp_matches(x, '^[0-9]+$') AND NOT regexp_matches(x, '^[0-9]{4}-[0-9]{2}-[0-9]{2}') AND length(p) > 0 THEN p END AS line FROM (SELECT *, trim(regexp_replace(regexp_replace(x, '[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9:.+]+', '', 'g'), ':\\s*[0-9]{2}/[0-9]{2}/[0-9]{4}', '', 'g')) AS p FROM (SELECT page_id, CAST(i AS INTEGER) AS i, trim(CASE i WHEN 1 THEN CAST(page_id AS VARCHAR) WHEN 2 THEN '2024-01-02 news' WHEN 3 THEN url || ' 2024-01-02T10:11:12+01:00 read' ELSE 'Updated: 19/12/2025' END) AS x FROM pages, (SELECT unnest(range(1, 5)) AS i)))")
def lines_without_stamps(spark, d):
    rows = spark.read.parquet(f"{d}/pages.parquet").select("page_id", F.posexplode(F.array(F.col("page_id").cast("string"), F.lit("2024-01-02 news"), F.concat("url", F.lit(" 2024-01-02T10:11:12+01:00 read")), F.lit("Updated: 19/12/2025"))).alias("at", "x"))
    return rows.select("page_id", (F.col("at") + 1).alias("i"), readers.without_stamps("x").alias("line"))


@query()
def nearest_items_of_lines(spark, d):
    """For each distinct line of all documents that has one, the benchmark item that it is most like; no SQL, as it would take all pairs."""
    lines = spark.read.parquet(f"{d}/documents.parquet").select(F.explode(F.split("text", "\n")).alias("s1"))
    items = spark.read.parquet(f"{d}/benchmark.parquet").select(F.col("text").alias("s2"))
    return _rounded(similarity.best_reference(similarity.similar_pairs(lines, items)), "distance", "prop_in_s1", "prop_in_s2")
