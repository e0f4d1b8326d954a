"""Every registered query of the library against its SQL in another engine."""

import math
from decimal import Decimal

import duckdb
import pytest

from codalith.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def other():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return connection


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return ""
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return f"{float(value):.6g}"
    return str(value)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, other, name):
    df = catalog.QUERIES[name](spark, DATA)
    rows = df.collect()
    if name not in catalog.SQL:
        assert rows
        return
    found = other.execute(catalog.SQL[name])
    names = [c[0] for c in found.description]
    order = sorted(names)
    assert sorted(df.columns) == order
    want = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in found.fetchall())
    assert sorted(tuple(plain(r[c]) for c in order) for r in rows) == want


def test_entry_imports_without_the_optional_parts():
    import __spark_entry__ as entry

    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert catalog.FLAGSHIP in catalog.QUERIES


def test_all_lines_of_all_texts_are_normalised(spark):
    rows = catalog.QUERIES["normalize_lines"](spark, DATA).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect() if r.text is not None}
    assert sorted((r.doc_id, r.line_no) for r in rows) == sorted((d, n + 1) for d, t in texts.items() for n in range(t.count("\n") + 1))
    assert max(r.line_no for r in rows) > 1
