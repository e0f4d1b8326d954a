"""The Merkle manifest against plain Python and its SQL."""

import hashlib
import string
import zlib

import duckdb
import pytest

from codalith.llm import merkle

from cases import documents, empty

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, tampered=False):
    values = [*row]
    if tampered and values[4] is not None:
        values[4] = values[4].translate(LOWER)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    """All levels over nodes, until one is left."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k : k + 16])) for k in range(0, len(out[-1]), 16)])
    return out


def way(tree, at):
    """(digests left of it, right of it) on each level above a node."""
    out = []
    for level in tree[:-1]:
        run = level[at // 16 * 16 : at // 16 * 16 + 16]
        out.append((run[: at % 16], run[at % 16 + 1 :]))
        at //= 16
    return out


def by_brute_force(rows):
    """rows: (doc_id, source, lang, n_chars, text)"""
    first = lambda v: (v is not None, v if v is not None else 0)
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append(row)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        sources[s].sort(key=lambda row: (first(row[0]), leaf(row)))
        trees[s] = levels([leaf(row) for row in sources[s]])
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for g, s in enumerate(order):
        for i, row in enumerate(sources[s]):
            links = way(trees[s], i) + way(top, g)
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            folded = leaf(row, bad)
            for left, right in links:
                folded = sha("".join([*left, folded, *right]))
            proof = sha("".join("".join(left + right) for left, right in links))
            out.append((row[0], leaf(row), trees[s][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)


def plain(df):
    return [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()]


def awkward():
    rows = [(d, s, "en", 3, f"Text {d} {s}") for s in (None, "", "é", "z", "Z") for d in range(-2, 20)]
    rows += [(5, "twice", None, None, None)] * 40 + [(5, "twice", "", 0, "")] * 3 + [(None, "z", "en", 1, "No ID")] * 2
    return rows + [(7, "lone", "en", 9, "ÀÉ UPPER " * 50), (8, "long", None, 400_000, "Word " * 80_000)]


def test_manifest_equals_plain_python(spark):
    rows = awkward()
    assert found(merkle.manifest(table(spark, rows))) == by_brute_force(rows)


def test_awkward_documents_and_no_rows(spark):
    docs = documents(spark)
    assert found(merkle.manifest(docs)) == by_brute_force(plain(docs))
    assert merkle.manifest(empty(spark)).collect() == []
    one = table(spark, [(None, None, None, None, None)])
    (row,) = merkle.manifest(one).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root == sha("-----") and row.verified and row.proof_sha256 == sha("")


@pytest.mark.parametrize("rows", [[(d, "hot" if d % 40 else f"s{d}", "en", 1, f"T{d}") for d in range(9000)], [(d, f"source {d * 7919 % 4500}", "en", 1, f"T{d}") for d in range(4600)]])
def test_more_nodes_than_one_task_resolves(spark, rows):
    """A source of more leaves, and more sources, than a subtree has take further rounds."""
    assert found(merkle.manifest(table(spark, rows))) == by_brute_force(rows)


def test_proofs_are_verified_one_by_one(spark):
    rows = [(d, f"s{d % 3}", "en", 1, f"Text {d}") for d in range(200)]
    made = merkle.manifest(table(spark, rows), with_proof=True)
    root = made.first().root
    assert {r.verified for r in merkle.verify(table(spark, rows), made, root).collect()} == {True}
    changed = [(d, s, la, n, t + "!" if d == 17 else t) for d, s, la, n, t in rows] + [(999, "s1", "en", 1, "new")]
    assert {r.doc_id: r.verified for r in merkle.verify(table(spark, changed), made, root).collect()} == {d: d not in (17, 999) for d, *_ in changed}


def test_parents_are_made_when_the_last_child_has_come():
    digests = [sha(str(k)).encode() for k in range(37)]
    tree = merkle.Tree(37)
    for k in reversed(range(37)):
        assert not tree.tops
        tree.add(k, digests[k])
        assert ((0, k // 16) in tree.runs) == (k % 16 == 0)  # children came from the last to the first
    want = levels([d.decode() for d in digests])
    assert tree.tops == [(0, 1, want[-1][0].encode())] and not tree.open
    assert all(merkle.fold(d, merkle.unpack_links(merkle.pack_links(tree.links(k)))) == tree.tops[0][2] for k, d in enumerate(digests))


def test_sql_equals_the_query_on_awkward_rows(spark, tmp_path):
    table(spark, awkward()).write.parquet(f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    answer = connection.execute(merkle.OP11_SQL)
    names = [c[0] for c in answer.description]
    df = merkle.op11_merkle_manifest(spark, str(tmp_path))
    assert sorted(names) == sorted(df.columns)
    # among equal rows the place is anyone's
    columns = [c for c in names if c != "position"]
    assert sorted(str([r[c] for c in columns]) for r in df.collect()) == sorted(str([r[names.index(c)] for c in columns]) for r in answer.fetchall())
