"""Small cases with known results."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from codalith.functions import codes, text
from codalith.operators import decision, hierarchy, metrics, rules, similarity
from codalith.sources import readers
from codalith.streaming import resume

STOP = ["de", "la", "le", "les", "du", "des", "et", "au"]
LABELS = [
    ("Crème  brûlée BIO", "creme brulee bio", "creme brulee bio"),
    ("  Œufs x12 (plein air)", " oeufs x12 (plein air)", "oeufs plein air"),
    ("lait Lait entier lait", "lait lait entier lait", "lait entier"),
    ("de la", "de la", ""),
    ("rien du tout", "rien du tout", "tout"),
    ("rien", "rien", None),
    ("12,50 €", "12,50 ", None),
    ("Légumes ½ prix", "legumes 12 prix", "legumes prix"),
    ("l’eau + gaz", "leau + gaz", "leau gaz"),
    (None, None, None),
]


def test_cleaning(spark):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(LABELS)], "i int, raw string").withColumn("l", text.normalize_label("raw"))
    for r in df.withColumn("s", text.strong_clean("l", STOP)).collect():
        assert (r.l, r.s) == LABELS[r.i][1:], LABELS[r.i]


def test_folding_equals_unicode(spark):
    chars = [chr(c) for low, high in text.FOLDED_BLOCKS for c in range(low, high)]
    df = spark.createDataFrame([(c,) for c in chars], "c string").withColumn("f", text.fold_ascii("c"))
    assert all(r.f == unicodedata.normalize("NFKD", r.c).encode("ascii", "ignore").decode() for r in df.collect())


def test_prices_and_lists(spark):
    df = spark.createDataFrame([("1 200,50",), ("-3",), ("//12,5 EUR",), ("",), (None,)], "t string")
    assert [(r.p, r.a) for r in df.select(text.price("t").alias("p"), text.amount("t").alias("a")).collect()] == [(1.0, None), (None, -3.0), (12.5, None), (None, None), (None, None)]
    answer = "Voici la liste :\n1. Pain\n- Lait\n• Œufs\n12) Riz\n\n" + "x" * 81 + "\nVoilà"
    assert spark.createDataFrame([(answer,)], "t string").select(text.list_items("t")).first()[0] == ["Pain", "Lait", "Œufs", "Riz"]


def test_common_prefix_and_levels(spark):
    rows = [("01.1.2.3", "01.1.4.3", "01.1"), ("01.1", "01.1.2", "01.1"), ("01.1", "02.1", None), ("01.1.10", "01.1.1", "01.1.1"), (None, "x", None)]
    df = spark.createDataFrame(rows, "a string, b string, w string")
    assert all(r.g == r.w for r in df.withColumn("g", codes.common_prefix("a", "b")).collect())
    rows = [("01.1.2", "01.1.2.3", [True, True, True, None, None]), ("01.1.2.3", "01.1.2", [True, True, True, False, None]), ("01.1.2.3", None, [False] * 4 + [None]), ("01", "01", [True] + [None] * 4)]
    for t, p, want in rows:
        got = spark.createDataFrame([(t, p)], "t string, p string").select(*[codes.level_result("t", "p", k) for k in range(1, 6)]).first()
        assert list(got) == want


def test_rules_in_order(spark):
    cases = {"courses alimentaires": "98.1.1", "divers courses": "98.1", "": "98.4", None: None, "Remise": "98.5", "remise fidelite": "Reprise manuelle", "12,50": "98.4", "fonciere": "99.4", "foncière": None, "pain": None}
    df = spark.createDataFrame([(k,) for k in cases], "l string").withColumn("c", rules.rule_code("l"))
    assert {r.l: r.c for r in df.collect()} == cases


PAIRS = [
    ("pain complet bio", "pain", "pain", 0.75, 0.25, 1.0), ("bio pain", "pain bio", "pain", 0.5, 0.5, 0.5), ("jambon blanc", "fromage blanc", " blanc", 0.538462, 0.5, 0.461538),
    ("abcd", "cdab", "ab", 0.5, 0.5, 0.5), ("abcde", "vwxya", "a", 0.8, 0.2, 0.2), ("abcdefghij", "zzzzzzzabz", "ab", 0.8, 0.2, 0.2), ("Pain", "pain", "Pain", 0.0, 1.0, 1.0),
]


def test_similar_pairs(spark):
    left = spark.createDataFrame([(p[0],) for p in PAIRS] + [("",)], "s1 string")
    right = spark.createDataFrame([(p[1],) for p in PAIRS], "s2 string")
    found = {(r.s1, r.s2): r for r in similarity.similar_pairs(left, right).collect()}
    for s1, s2, common, distance, p1, p2 in PAIRS:
        r = found[s1, s2]
        assert (r.common_substring, round(r.distance, 6), round(r.prop_in_s1, 6), round(r.prop_in_s2, 6)) == (common, distance, p1, p2)
    assert not any(s1 == "" for s1, _ in found)

    def size(a, b):
        return max((n for i in range(len(a)) for n in range(1, len(a) - i + 1) if a[i : i + n].upper() in b.upper()), default=0)

    want = {(a[0], b[1]) for a in PAIRS for b in PAIRS if a[0] != b[1] and round(1 - size(a[0], b[1]) / max(len(a[0]), len(b[1])), 9) <= 0.8}
    assert set(found) == want


def test_pruning(spark):
    tree = spark.createDataFrame([(c,) for c in ("01", "01.1", "01.1.1", "01.2", "01.3", "01.3.1", "01.3.2")], "code string")
    assert {r.code: r.code_parent_equivalent for r in hierarchy.prune_mapping(tree).collect()} == {"01.1": "01.1", "01.1.1": "01.1", "01.2": "01.2", "01.3.1": "01.3.1", "01.3.2": "01.3.2"}


def test_consensus(spark):
    rows = [("A", 0.95, "A", "A", "A"), ("A", 0.95, None, None, "A"), ("A", 0.95, "A", "B", None), ("A", 0.89, "A", "A", None), (None, 0.95, "A", "A", None), ("A", 0.90, "A", "A", "A")]
    df = spark.createDataFrame(rows, "t string, c double, l string, r string, w string")
    assert all(r.g == r.w for r in df.withColumn("g", decision.consensus("t", "c", ["l", "r"])).collect())


GOLDEN = [
    ("01.1.1.1.2", "01.1.1.1.2", "01.1.1.1.2, 01.1.1.2.0, 01.1.2.0.0"), ("01.1.8.3.5", "01.1.8.3.7", "01.1.8.1.0, 01.1.8.2.0, 01.1.7.0.0"), ("02.1.2.0.0", "02.1.1.1.0", "02.1.1.1.0, 02.1.2.0.0, 02.1.3.0.0"),
    ("08.2.1.0.0", "08.2.0.1.0", "08.2.1.0.0, 08.3.0.0.0, 09.1.0.0.0"), ("01.2.1.0.3", "01.2.1.0.1", "01.2.1.0.1, 01.2.1.0.2, 01.2.2.0.0"), ("01.1.4.2.0", "01.1.4.2.0", "01.1.4.2, 01.1.4.0.0, 01.1.5.0.0"),
    ("02.1.1.2.0", "02.1.1.1.0", "02.1.1.1.0, 02.1.1.2.0, 02.1.2.0.0"), ("07.2.2", "07.2.2", "07.2.2, 07.2.1.0.0, 07.2.3.0.0"), ("01.1.7.2.9", "01.1.7.2.5", "01.1.7.2.1, 01.1.7.3.0, 01.1.6.0.0"), (None, "13.9.9.9.9", ""),
]


def test_retrieval_golden(spark):
    df = spark.createDataFrame([(p, c, [x for x in r.split(", ") if x]) for p, c, r in GOLDEN], "p string, c string, r array<string>")
    found = {r.level: (round(r.accuracy, 6), round(r.retrieval_accuracy, 6), round(r.generation_accuracy, 6)) for r in metrics.retrieval_accuracy(df, "c", "p", "r", [1, 2, 3, 4, 5], {"all": F.lit(True)}).collect()}
    assert found == {1: (0.9, 0.9, 1.0), 2: (0.9, 0.9, 1.0), 3: (0.7, 0.8, 0.875), 4: (0.6, 0.7, 0.714286), 5: (0.3, 0.5, 0.4)}


def test_readers_and_resume(spark, tmp_path):
    df = spark.createDataFrame([("1", "01.1", "2,5"), ("2", "02", None)], "product string, code string, amount string")
    for name in ("a.parquet", "b.csv"):
        readers.write_any(df, f"{tmp_path}/{name}")
        assert readers.read_any(spark, f"{tmp_path}/{name}").count() == 2
    assert [r.amount for r in readers.read_annotated(spark, f"{tmp_path}/b.csv").orderBy("product").collect()] == [2.5, None]
    assert readers.sniff_separator(spark, f"{tmp_path}/b.csv") == ";"
    with pytest.raises(ValueError):
        readers.read_any(spark, "x.txt")
    df.write.partitionBy("code").parquet(f"{tmp_path}/p")
    assert readers.read_partitioned(spark, f"{tmp_path}/p", "code = '02'").count() == 1
    assert readers.expand_paths({"a": ["{x}/b", 1]}, x="r") == {"a": ["r/b", 1]}
    done = spark.createDataFrame([("1", "boom")], "product string, error string")
    assert resume.pending(df, done, "product").count() == 1 and resume.pending(df, done, "product", retry_errors=True).count() == 2
    for _ in range(2):
        resume.decide_stream(spark, f"{tmp_path}/a.parquet", df.schema, f"{tmp_path}/out", f"{tmp_path}/cp", lambda b: b).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2
