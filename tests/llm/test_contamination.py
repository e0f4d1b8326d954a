"""The positional index, phrases, proximity and decontamination against plain Python."""

import hashlib
import itertools
import re
import string

import duckdb
import numpy as np
import pytest

from codalith.llm import contamination, words

from cases import documents, empty

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def by_brute_force(docs, items, width=10):
    out = []
    phrases = {}
    for item_id, text in items:
        w = split(text)
        n = min(width, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            phrases.setdefault(tuple(w[k : k + n]), set()).add(item_id)
    sizes = {len(p) for p in phrases}
    for doc_id, text in docs:
        w = split(text)
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (owners := phrases.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= {str(x) for x in owners if x is not None}
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()), key=str)


RANDOM = np.random.default_rng(5)


def draw(n, pool=12):
    return " ".join(RANDOM.choice([f"w{k}" for k in range(pool)], n).tolist())


PASSAGE = "The Quick-brown fox; JUMPS over 13 lazy dogs and naïve 日本 cats, again and again."
ITEMS = [
    (1, PASSAGE), (2, "one two"), (3, None), (4, "..."), (5, PASSAGE + " more of it follows"), (None, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (10, "same"), (2, "ONE two"), (6, "absent words are never found in any text at all, not here"),
    (7, "w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1"), (20, "shared0 shared1 shared2 shared3 shared4 shared5 shared6 shared7 shared8 shared9 shared10"),
]
MORE = [(100, "before " + PASSAGE + " after"), (101, PASSAGE + "\n" + PASSAGE), (102, "w1 " * 5000), (103, "the quick brown fox jumps over 13 lazy dogs"), (104, draw(3000)), (104, draw(40)), (105, "and naïve 日本 cats again and again one"), (106, "two")]


def items_table(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id long, text string").repartition(2)


def test_decontamination_equals_plain_python(spark):
    docs = documents(spark).unionByName(documents(spark, MORE))
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    want = by_brute_force(texts, ITEMS)
    assert rows(contamination.contamination(docs, items_table(spark))) == want and sum(w[5] for w in want) > 8


def test_blocks_slabs_and_hot_terms(spark):
    """Many small blocks and slabs, few terms, long lists and items that are everywhere."""
    texts = [(k, draw(400, 3)) for k in range(30)] + MORE
    items = [(k, draw(14, 3)) for k in range(60)] + ITEMS
    index = contamination.build_index(documents(spark, texts), block_bytes=2000)
    assert index.count() > 15
    found = contamination.phrase_matches(index, items_table(spark, items), width=8, slab_bytes=600)
    got = sorted(((r.doc_id, r.n_words, sum(s["last"] - s["first"] + 1 for s in r.spans), len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), bool(r.spans)) for r in found.collect()), key=str)
    assert got == by_brute_force(texts, items, 8)


def test_no_documents_and_no_items(spark):
    assert contamination.contamination(empty(spark), items_table(spark)).collect() == []
    none = items_table(spark, ITEMS).limit(0)
    assert rows(contamination.contamination(documents(spark), none)) == by_brute_force([(r.doc_id, r.text) for r in documents(spark).collect()], [])


def near_by_brute_force(text, query, within):
    w, asked = split(text), set(split(query))
    runs = [(a, b) for a, b in itertools.product(range(len(w)), repeat=2) if 0 <= b - a < within and asked and asked <= set(w[a : b + 1])]
    return sorted((a, b) for a, b in runs if not any((c, d) != (a, b) and a <= c and d <= b for c, d in runs))


@pytest.mark.parametrize("within", [3, 7])
def test_proximity_equals_all_runs(spark, within):
    texts = [(k, draw(60, 6)) for k in range(12)] + [(50, "fox and dog"), (51, None), (52, "dog")]
    queries = [(1, "w1 w4 w2"), (2, "w0"), (3, "dog Fox"), (4, "w5 w5 w3"), (5, "nowhere w1"), (6, "")]
    found = contamination.proximity_matches(contamination.build_index(documents(spark, texts), 500), items_table(spark, queries), within)
    got = sorted((r.doc_id, int(r.item_id), r.first, r.last) for r in found.collect())
    assert got == sorted((d, q, a, b) for d, t in texts for q, asked in queries for a, b in near_by_brute_force(t, asked, within)) and len(got) > 50


def test_terms_of_equal_hashes_are_told_apart(monkeypatch):
    honest = words.hashes
    monkeypatch.setattr(words, "hashes", lambda data, starts, ends, seed=0, step=1 << 16: honest(data, starts, ends, seed, step) % np.uint64(7 if not seed else 1 << 63))
    texts = [" ".join(f"t{k}" for k in range(60)), "t3 t4 t5 t6 and t59 t58 again t3 t4 t5"]
    block = contamination.Block.of(0, *contamination.common.utf8(contamination.pa.array(texts)), np.arange(2), np.ones(2, bool))
    again = contamination.Block.read(dict(zip([x.split()[0] for x in contamination._INDEX.split(", ")], block.row())))
    asked = contamination.Phrases.of(contamination.pa.array(["t3 t4 t5", "t59 t58", "t58 t3", "other"]), ["a", "b", "c", "d"], 10)
    phrase, place = asked.search(again)
    assert sorted((asked.names_of(np.array([p]))[0], x) for p, x in zip(phrase.tolist(), place.tolist())) == [("a", 3), ("a", 60), ("a", 68), ("b", 65)]


def test_sql_equals_the_query_on_awkward_rows(spark, tmp_path):
    documents(spark, [*MORE, (None, PASSAGE), (3, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    items_table(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    connection = duckdb.connect()
    for t in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    answer = connection.execute(contamination.OP12_SQL)
    names = [c[0] for c in answer.description]
    want = sorted(tuple(r[names.index(c)] for c in ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) for r in answer.fetchall() if r[names.index("doc_id")] is not None)
    assert [r for r in rows(contamination.op12_decontaminate(spark, str(tmp_path))) if r[0] is not None] == sorted(want, key=str)


def test_the_index_is_written_in_small_row_groups(spark):
    """Else a task with many blocks holds them all until a hundred rows are written."""
    from pyarrow import parquet

    docs = documents(spark, [(k, f"w{k} " * 50) for k in range(60)]).coalesce(1)
    index = contamination.build_index(docs, block_bytes=100)
    files = [parquet.ParquetFile(f.removeprefix("file://")).metadata for f in index.inputFiles()]
    sizes = [f.row_group(k).num_rows for f in files for k in range(f.num_row_groups)]
    assert sum(sizes) == index.count() == 60 and max(sizes) <= contamination.GROUP_ROWS
