"""The observation view: labels, codes and predictions made from the table orders by integer arithmetic.

The column formulas are texts that Spark SQL and other engines read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LABELS = ("pain complet bio", "Crème  brûlée", "fruits légumes", "courses alimentaires", "restaurant", "carte bancaire", "remise fidelite", "drive du samedi", "12,50", "", "librairie martin", "Œufs x12 (plein air)", "repas midi", "divers", "lait Lait entier lait", "rien du tout")


def _code(k: str) -> str:
    first = f"CASE ({k}) % 14 WHEN 12 THEN '98' WHEN 13 THEN '99' ELSE lpad(CAST(({k}) % 14 + 1 AS STRING), 2, '0') END"
    rest = "".join(f" || CASE WHEN ({k}) % 5 >= {n} THEN '.' || CAST(({k}) % {m} + 1 AS STRING) ELSE '' END" for n, m in ((1, 9), (2, 7), (3, 4)))
    return f"CASE WHEN ({k}) % 97 = 0 THEN NULL ELSE {first}{rest} END"


_K, _C = "o_orderkey", "o_custkey"
COLUMNS = {
    "id": f"CAST({_K} AS STRING)",
    "num": _K,
    "label": "CASE " + " ".join(f"WHEN {_K} % {len(LABELS) + 1} = {i} THEN '{x}'" for i, x in enumerate(LABELS)) + " END",
    "code": _code(_K),
    "predicted": f"CASE WHEN {_C} % 89 = 0 THEN NULL ELSE {_code(f'{_K} + CASE WHEN {_C} % 5 < 3 THEN 0 ELSE {_C} % 11 END')} END",
    "top2": _code(f"{_K} + CASE WHEN {_C} % 3 = 0 THEN 0 ELSE {_C} % 7 END"),
    "top3": _code(f"{_K} + {_C} % 6"),
    "lcs_code": f"CASE WHEN {_C} % 4 = 0 THEN NULL ELSE {_code(f'{_K} + CASE WHEN {_C} % 3 = 0 THEN 0 ELSE 1 END')} END",
    "rag_code": f"CASE WHEN {_C} % 7 = 0 THEN NULL ELSE {_code(f'{_K} + CASE WHEN {_C} % 2 = 0 THEN 0 ELSE 2 END')} END",
    "confidence": f"CAST({_K} % 101 AS DOUBLE) / 100",
    "source": "o_orderstatus",
    "shop": f"CASE WHEN {_C} % 13 = 0 THEN NULL ELSE CAST({_C} % 50 AS STRING) END",
    "shop_type": "o_orderpriority",
    "budget": f"CASE WHEN {_K} % 17 = 0 THEN NULL ELSE CAST({_K} % 25000 AS DOUBLE) / 100 END",
    "annee": "year(o_orderdate)",
}

#: A common table expression obs for the SQL of the queries.
CTE = "WITH obs AS (SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in COLUMNS.items()) + " FROM orders)"


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(*[f"{sql} AS {name}" for name, sql in COLUMNS.items()])
