import numpy as np
import pytest
from pyspark.sql import functions as F

from codalith.llm import chat, vector_search


def brute(rows, k=10, every=100):
    usable = [(i, np.floor(1024 * np.array(v, np.float64)).astype(int)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, q in usable:
        if i % every:
            continue
        scored = sorted((-int(q @ v), j) for j, v in usable if j != i and len(v) == len(q))[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    random = np.random.default_rng(2)
    rows = [(i, [float(x) for x in random.normal(size=8) * 0.3]) for i in range(700)]
    rows += [(700 + i, rows[i % 3][1]) for i in range(30)]  # ties
    rows += [(800, None), (900, [1.0, None, *[0.0] * 6]), (1000, [float("nan"), *[0.0] * 7]), (1100, [float("inf")] * 8), (None, rows[0][1]), (1200, [0.5, 0.25]), (1300, []), (1201, [0.1, 0.2])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, dim int, ids string").repartition(4)
    want = brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows])
    found = sorted(tuple(r) for r in vector_search.top_k(df, F.col("vec_id") % 100 == 0).collect())
    assert found == want
    assert vector_search.top_k(df.where("false"), F.col("vec_id") % 100 == 0).count() == 0


@pytest.mark.parametrize("size", [0.3, 3e9])
def test_bounds_hold_and_few_exact_vectors_are_read(size):
    random = np.random.default_rng(4)
    v = np.floor(1024 * size * random.normal(size=(4000, 16))).astype(np.int64)
    ids = np.arange(4000)
    owners = np.stack([ids, (ids % 2 == 0).astype(int)], axis=1)  # nodes of odd numbers hold several ids
    scan = vector_search.Scan(ids[:20], owners[:20], v[:20].astype(np.float64), 11)
    for at in range(0, 4000, 1000):
        cells, edges = vector_search.cells_of(v[at : at + 1000])
        scan.meet(ids[at : at + 1000], owners[at : at + 1000], cells, edges)
    rows = scan.close().to_pydict()
    exact = {(n, k): int(sum(int(x) * int(y) for x, y in zip(v[n], v[k]))) for n in range(20) for k in range(4000)}
    assert all(low <= exact[u, k] <= high for u, k, low, high in zip(rows["unit"], rows["node"], rows["lower"], rows["upper"]))
    for n in range(20):
        best = sorted((k for k in range(4000) if n % 2 or k != n), key=lambda k: -exact[n, k])[:11]  # noqa: B023
        near = {k for u, k in zip(rows["unit"], rows["node"]) if u == n}
        assert near.issuperset(best) and len(near) < 400


def test_rows_that_share_a_query_id_are_left_out_while_cells_are_scanned():
    """An id in very many rows costs its own query no reads, and others none more than before."""
    random = np.random.default_rng(8)
    v = np.floor(1024 * random.normal(size=(7000, 16))).astype(np.int64)
    ids = np.arange(7000)
    reads = {}
    for repeated in (False, True):
        owner = np.where(ids >= 4000, 0, ids) if repeated else ids
        n = 7000 if repeated else 4000
        owners = np.stack([owner, np.ones(7000, int)], axis=1)
        scan = vector_search.Scan(ids[:40], owners[:40], v[:40].astype(np.float64), 10)
        for at in range(0, n, 1000):
            cells, edges = vector_search.cells_of(v[at : at + 1000])
            scan.meet(ids[at : at + 1000], owners[at : at + 1000], cells, edges)
        rows = scan.close().to_pydict()
        reads[repeated] = len(rows["unit"])
        if repeated:
            of_first = {k for u, k in zip(rows["unit"], rows["node"]) if u == 0}
            assert not of_first & {0, *range(4000, 7000)} and of_first >= set(sorted(range(1, 4000), key=lambda k: -int(v[0] @ v[k]))[:10])
    assert reads[True] < 2 * reads[False]


def test_an_id_in_many_rows_equals_brute_force(spark):
    random = np.random.default_rng(6)
    rows = [(i, [float(x) for x in random.normal(size=5) * 0.3]) for i in range(301)]
    rows += [(100, [float(x) for x in random.normal(size=5) * 0.3]) for _ in range(250)] + [(200, rows[7][1])] * 30 + [(300, rows[0][1]), (7, rows[100][1]), (100, rows[200][1]), (100, rows[100][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    usable = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows]
    want = []
    for i in (0, 100, 200, 300):
        q = min(v for j, v in usable if j == i)
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i)[:10]
        want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    assert sorted(tuple(r) for r in vector_search.top_k(df, F.col("vec_id") % 100 == 0).collect()) == want


def test_large_components_and_many_copies(spark):
    random = np.random.default_rng(9)
    rows = [(i, [float(x) for x in random.normal(size=4) * 2.0**30]) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(210)] + [(500, rows[5][1]), (500, rows[5][1]), (600, rows[5][1]), (600, rows[6][1]), (700, [1e300, 0.0, 0.0, 0.0]), (701, [2.0**43, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    usable = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows if max(map(abs, v)) < 2.0**42]
    want = []
    for i in sorted({i for i, _ in usable if i % 100 == 0}):
        q = min(v for j, v in usable if j == i)
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i)[:10]
        want += [(i, n + 1, j, max(-(2**63), min(2**63 - 1, -s))) for n, (s, j) in enumerate(scored)]
    assert any(x[3] == 2**63 - 1 for x in want)
    assert sorted(tuple(r) for r in vector_search.top_k(df, F.col("vec_id") % 100 == 0).collect()) == want


TURNS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"), (1, 3, "user", "bye"),
    (0, 0, "user", "yo"), (0, 1, "assistant", "hello"),
    (2, 0, None, None), (2, 1, "assistant", ""), (3, 0, "user", "only a question"),
    (5, 0, "assistant", "Ünï"), (5, 0, "assistant", "Ünï"), (None, 0, "user", "lost"),
]


def test_preference_formatting(spark):
    turns = spark.createDataFrame([(*t, "x") for t in TURNS], "conv_id long, turn long, role string, text string, pair_id string")
    rows = {r.pair_id: r for r in chat.format_preferences(chat.preference_pairs(turns)).collect()}
    assert set(rows) == {0, 1, 2, 5}
    one = rows[1]  # the neighbour's reply is the same, so only the trailing turn differs
    assert one.n_prompt_turns == 3 and one.rejected == "" and one.chosen == "<|im_start|>user\nbye<|im_end|>\n" and one.chosen_mask == []
    two = rows[2]
    assert two.prompt == "<|im_start|>unknown\n<|im_end|>\n" and two.rejected == "" and [tuple(x) for x in two.chosen_mask] == [(len("<|im_start|>assistant\n"), len("<|im_end|>\n"))]
    five = rows[5]
    assert five.n_prompt_turns == 1 and [five.chosen[a : a + n] for a, n in five.chosen_mask] == ["Ünï<|im_end|>\n"]
    assert chat.format_preferences(chat.preference_pairs(turns.where("false"))).count() == 0


def test_prefix_of_given_pairs(spark):
    schema = "pair_id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>"
    a, b, c = ("user", "q"), ("assistant", "x"), ("assistant", "y")
    df = spark.createDataFrame([(1, [a, b], [a, c]), (2, [a, b], [a, b]), (3, [], [a]), (4, [c], [a])], schema)
    rows = {r.pair_id: r for r in chat.format_preferences(df).collect()}
    assert [rows[k].n_prompt_turns for k in (1, 2, 3, 4)] == [1, 2, 0, 0]
    assert rows[1].rejected.endswith("y<|im_end|>\n") and rows[2].chosen == "" and rows[3].prompt == ""


def test_null_turns_of_given_pairs(spark):
    schema = "pair_id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt string"
    df = spark.createDataFrame([(1, [("user", None), ("assistant", "x")], [("user", ""), ("assistant", None)], "p"), (2, None, [(None, "x")], "p"), (3, [None], [(None, None)], "p")], schema)
    rows = {r.pair_id: r for r in chat.format_preferences(df).collect()}
    assert [rows[k].n_prompt_turns for k in (1, 2, 3)] == [1, 0, 1]
    assert rows[1].rejected == "<|im_start|>assistant\n<|im_end|>\n" and [tuple(x) for x in rows[1].rejected_mask] == [(22, 11)]
    assert rows[2].prompt == rows[2].chosen == "" and rows[2].rejected == "<|im_start|>unknown\nx<|im_end|>\n" and rows[3].prompt == "<|im_start|>unknown\n<|im_end|>\n"
