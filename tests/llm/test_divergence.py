"""The source divergence audit against plain Python and its SQL."""

import re
import string
from collections import Counter

import duckdb
import numpy as np

from codalith.llm import divergence

from cases import documents, empty

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
B = 1_000_000_000


def by_brute_force(rows, min_documents=3, top=200):
    """rows: (lang, source, text)"""
    rows = [tuple(x or "" for x in r) for r in rows]
    out = []
    for lang in {r[0] for r in rows}:
        held, counts = Counter(), {s: Counter() for la, s, _ in rows if la == lang}
        for la, s, text in rows:
            if la == lang:
                terms = TERM.findall(text.translate(LOWER))
                held.update(set(terms))
                counts[s].update(terms)
        kept = sorted(t for t, n in held.items() if n >= min_documents)
        v = len(kept)
        share = lambda c, n: 1 + B * (c + 1) // (n + v)
        p = {s: [share(c[t], sum(c[x] for x in kept)) for t in kept] for s, c in counts.items()}
        whole = sum((c for c in counts.values()), Counter())
        q = [share(whole[t], sum(whole[x] for x in kept)) for t in kept]
        for s in counts:
            pairs = [(x, sum((a - b) ** 2 // b for a, b in zip(p[s], p[x]))) for x in counts if x != s]
            terms = [(t, (a - b) ** 2 // b) for t, a, b in zip(kept, p[s], q) if counts[s][t] and a > b]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ordered)]
    return sorted(out)


def found(df):
    return sorted((r.lang, r.source, r.part, r["item"], r.value, r.rank) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, lang string, source string, text string").repartition(5)


RANDOM = np.random.default_rng(3)


def draw(n, pool):
    return " ".join(RANDOM.choice([f"T{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(pool)], n).tolist())


def awkward():
    rows = [(la, s, draw(30, 40)) for la in ("en", None, "", "é") for s in (None, "", "a", "É") for _ in range(4)]
    rows += [("en", "hot", draw(200, 60)) for _ in range(50)] + [("en", "hot", "same same ties ties equal equal")] * 9
    rows += [("fr", "rare", "un deux"), ("fr", "other", "trois quatre"), ("de", "alone", draw(20, 5)), ("de", "alone", None), ("en", "silent", "12 34 !?"), ("en", "silent", None)]
    return rows + [("en", "long", "Straße ÉCOLE naïve-co2x " * 20_000), ("es", "lone", "uno")]


def test_audit_equals_plain_python(spark):
    rows = awkward()
    assert found(divergence.divergences(table(spark, rows))) == by_brute_force(rows)


def test_few_terms_are_listed_to_the_rank_asked_for(spark):
    rows = awkward()
    assert found(divergence.divergences(table(spark, rows), min_documents=2, top=3)) == by_brute_force(rows, 2, 3)


def test_more_sources_than_a_task_compares_at_once(spark):
    rows = [("en", f"s{k % 300}", draw(12, 30)) for k in range(600)]
    assert found(divergence.divergences(table(spark, rows))) == by_brute_force(rows)


def test_awkward_documents_and_no_rows(spark):
    docs = documents(spark)
    assert found(divergence.divergences(docs)) == by_brute_force([(r.lang, r.source, r.text) for r in docs.collect()])
    assert divergence.divergences(empty(spark)).collect() == []


def test_shares_beyond_64_bits_of_product():
    counts = np.array([[0, 1, 10**10, 7 * 10**14, 9 * 10**15 - 5], [3, 2, 1, 0, 8 * 10**15]], np.int64)
    totals = np.array([[9 * 10**15 + 7], [8 * 10**15 + 99]], np.int64)
    want = [[1 + B * (int(c) + 1) // int(t[0]) for c in row] for row, t in zip(counts, totals)]
    assert divergence.shares(counts, totals).tolist() == want
    assert divergence.shares(counts[:, :2], totals).tolist() == [r[:2] for r in want]


def test_sql_equals_the_query_on_awkward_rows(spark, tmp_path):
    table(spark, awkward()).write.parquet(f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    answer = connection.execute(divergence.OP13_SQL)
    names = [c[0] for c in answer.description]
    want = sorted(tuple(r[names.index(c)] for c in ("lang", "source", "part", "item", "value", "rank")) for r in answer.fetchall())
    assert found(divergence.op13_source_divergence(spark, str(tmp_path))) == want
