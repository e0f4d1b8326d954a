import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from codalith.operators import metrics, predictions, similarity, training


def upper(s):
    return "".join(c.upper() if c.isascii() else c for c in s)


def brute(a, b):
    x, y = upper(a), upper(b)
    size, start = max((n, -i) for i in range(len(x)) for n in range(len(x) - i + 1) if x[i : i + n] in y)
    return -start, size


LABELS = ["ßßß", "ßß abcdef", "pain complet bio", "Pain", "bio pain", "jambon blanc", "abcd", "abcde", "abcdefghij", "x", "œuf", "", None, "a b", "ﬁlet de bœuf haché 15 % de matière grasse", "BŒUF"]
REFERENCES = ["ßßßx", "xx abcdef", "pain", "pain bio", "fromage blanc", "cdab", "vwxya", "zzzzzzzabz", "X", "ŒUF", "", None, "b a", "bœuf haché", "bœuf"]


def test_similar_pairs_equal_all_pairs(spark):
    random = np.random.default_rng(2)
    draw = lambda n: ["".join(random.choice(list("abcß "), random.integers(1, 14))) for _ in range(n)]
    left, right = [*LABELS, *draw(60)], [*REFERENCES, *draw(60)]
    want = set()
    for a in {x for x in left if x}:
        for b in {x for x in right if x}:
            i, n = brute(a, b)
            if a != b and round(1 - n / max(len(a), len(b)), 9) <= 0.8:
                want.add((a, b, round(1 - n / max(len(a), len(b)), 9), a[i : i + n], round(n / len(a), 9), round(n / len(b), 9)))
    found = similarity.similar_pairs(spark.createDataFrame([(x,) for x in left], "s1 string"), spark.createDataFrame([(x,) for x in right], "s2 string"))
    rows = [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    assert ("ßßß", "ßßßx", 0.25, "ßßß", 1.0, 0.75) in want and ("ßß abcdef", "xx abcdef", round(2 / 9, 9), " abcdef", round(7 / 9, 9), round(7 / 9, 9)) in want


def test_long_lists_meet_in_few_candidates(spark):
    random = np.random.default_rng(3)
    names = ["".join(random.choice(list("abcdefghijklmnopqrstuvwxyz"), 30)) for _ in range(10_000)]
    labels = spark.createDataFrame([(x,) for x in names], "s1 string")
    references = spark.createDataFrame([(x[:25] + "-----",) for x in names], "s2 string")
    nearest = similarity.best_reference(similarity.similar_pairs(labels, references)).select("s1", "s2", "distance").collect()
    assert len(nearest) == 10_000 and all(r.s1[:25] == r.s2[:25] and abs(r.distance - 1 / 6) < 1e-9 for r in nearest)


def test_labels_of_very_different_lengths_equal_all_pairs(spark):
    """Labels of 2000 characters beside short ones: the same pairs as all pairs give, and rows of numbers alone."""
    random = np.random.default_rng(7)
    draw = lambda n: "".join(random.choice(list("abcdefgh "), n))
    long = [draw(2000) for _ in range(4)]
    left = [*long, draw(450), *(draw(n) for n in (3, 20, 60, 90, 250)), "ABCD" * 500]
    right = [long[0][700:1200] + draw(900), long[1][:399], long[1][:400], long[2].upper()[100:] + "!", "x" + left[5], draw(30), "abcd" * 450 + draw(200), left[4][:80]]
    want = set()
    for a in left:
        for b in right:
            i, n = similarity.longest_common(a, b)
            assert similarity.Substrings(b.upper()).common(a.upper()) == (i, n)
            if a != b and round(1 - n / max(len(a), len(b)), 9) <= 0.8:
                want.add((a, b, a[i : i + n]))
    found = similarity.similar_pairs(spark.createDataFrame([(x,) for x in left], "s1 string"), spark.createDataFrame([(x,) for x in right], "s2 string"))
    rows = [(r.s1, r.s2, r.common_substring) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want and (long[1], long[1][:400]) in {r[:2] for r in rows} and (long[1], long[1][:399]) not in {r[:2] for r in rows}


def test_lines_and_items_equal_all_pairs(spark, tmp_path):
    from codalith.plans import catalog

    random = np.random.default_rng(12)
    words = [chr(97 + k) * 3 + "o" for k in range(20)]
    draw = lambda n: " ".join(random.choice(words, n))
    items = [draw(12) for _ in range(6)] + [None, ""]
    texts = [f"{draw(8)}\n{items[k % 6]}!\n{items[k % 5][:30]} {draw(6)}\n\n" for k in range(12)] + [None, items[0], draw(400)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = {}
    for a in {x for t in texts if t for x in t.split("\n") if x}:
        near = []
        for b in filter(None, items):
            i, n = similarity.longest_common(a, b)
            if a != b and round(1 - n / max(len(a), len(b)), 9) <= 0.8:
                near.append((round(1 - n / max(len(a), len(b)), 9), -round(n / len(b), 9), b))
        if near:
            want[a] = min(near)[2]
    found = {r.s1: r.s2 for r in catalog.QUERIES["nearest_items_of_lines"](spark, str(tmp_path)).collect()}
    assert found == want and len(found) > 20


def test_automaton_equals_all_substrings():
    random = np.random.default_rng(8)
    for _ in range(300):
        a, b = ("".join(random.choice(list("abé"), random.integers(0, 12))) for _ in range(2))
        if a and b:
            assert similarity.Substrings(upper(b)).common(upper(a)) == brute(a, b) or not brute(a, b)[1]


def test_hashes_of_runs_are_those_of_the_runs():
    random = np.random.default_rng(1)
    points = random.integers(1, 4, 60).astype(np.uint64)
    for size in (1, 2, 3, 7, 8, 31, 60):
        h = similarity.run_hashes(points, size)
        runs = [tuple(points[k : k + size].tolist()) for k in range(60 - size + 1)]
        assert len(set(zip(runs, h.tolist()))) == len(set(runs)) == len(set(h.tolist()))
    assert len(similarity.run_hashes(points, 61)) == 0
    for n in range(1, 400):  # each partner of a label has a class in which both are
        smallest = similarity.length_classes(5 * n)
        assert all(similarity.needed(smallest[k]) <= similarity.needed(n) for k in range(len(smallest)) if smallest[k] <= n)


@pytest.mark.parametrize("kind", ["normal", "few", "one", "wide"])
def test_quantiles_are_exact(spark, kind):
    random = np.random.default_rng(4)
    values = {"normal": random.normal(size=3000), "few": random.integers(0, 4, 500).astype(float), "one": np.array([7.5]), "wide": np.r_[random.lognormal(0, 30, 800), -1e308, 1e308, 0.0]}[kind].tolist()
    rows = [("a" if k % 3 else None, v) for k, v in enumerate(values)] + [("a", None), ("a", math.nan), ("b", math.inf)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    found = metrics.quantiles(df, "v", shares, F.col("g"), cells=16)
    for g in found:
        own = sorted(v for k, v in rows if k == g and v is not None and math.isfinite(v))
        for q, x in zip(shares, found[g]):
            place = (len(own) - 1) * q
            low, high = own[int(place)], own[min(int(place) + 1, len(own) - 1)]
            assert math.isclose(x, low + (high - low) * (place - int(place)), rel_tol=1e-12, abs_tol=1e-12)
    assert set(found) == {k for k, v in rows if v is not None and math.isfinite(v)}
    assert metrics.quantiles(df.where("false"), "v", shares) == {}


def test_stratified_split_of_a_hot_and_a_null_label(spark):
    rows = [(k, "hot" if k % 10 else None if k % 20 else f"c{k % 7}") for k in range(4000)]
    found = training.stratified_split(spark.createDataFrame(rows, "id long, label string"), "label", "id").collect()
    mark = lambda k: (hashlib.md5(f"42|{k}".encode()).hexdigest(), k)
    for label in {c for _, c in rows}:
        own = sorted((k for k, c in rows if c == label), key=mark)
        tests = {r.id for r in found if r.label == label and r.part == "test"}
        assert tests == set(own[: math.ceil(len(own) * 20 / 100)])
    assert len(found) == len(rows)


def test_thresholds_reached(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (0.29,), (1.0,), (None,), (math.nan,)], "c double")
    steps = [k / 20 for k in range(21)]
    for r in df.withColumn("n", metrics.thresholds_reached("c", 21, 20)).collect():
        assert r.n == sum(1 for t in steps if r.c is not None and (r.c >= t or math.isnan(r.c)))


def test_evaluation_frame_prunes_by_first_level(spark):
    predicted = spark.createDataFrame([(1, "01.1.2", ["02.1.1", "03", None]), (2, None, [])], "id long, predicted string, retrieved array<string>")
    truth = spark.createDataFrame([(1, "01.1.3"), (2, "02.1.1.4")], "id long, code string")
    mapping = spark.createDataFrame([("01.1.2", "01.1"), ("02.1.1", "02")], "code string, code_parent_equivalent string")
    rows = {r.id: r for r in predictions.evaluation_frame(predicted, truth, mapping, level=3).collect()}
    assert (rows[1].code_cut, rows[1].predicted_cut, rows[1].retrieved_cut) == ("01.1.3", "01.1", ["02", "03", None])
    assert (rows[2].code_cut, rows[2].predicted_cut, rows[2].retrieved_cut) == ("02", None, [])
