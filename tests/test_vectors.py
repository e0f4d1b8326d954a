import numpy as np

from codalith.operators import vectors


def brute(rows, every, k=10):
    v = np.array([r[1] for r in rows], np.float32).astype(np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    ids = np.array([r[0] for r in rows])
    out = []
    for n in np.flatnonzero(ids % every == 0).tolist():
        score = np.round(v @ v[n], 9)
        out += [(int(ids[n]), rank + 1, int(ids[m])) for rank, m in enumerate([m for m in np.lexsort((ids, -score)).tolist() if m != n][:k])]
    return sorted(out)


def test_equal_vectors_are_cut_by_vec_id(spark):
    random = np.random.default_rng(1)
    copies = [[float(x) for x in random.normal(size=4)] for _ in range(3)]
    rows = [(i, copies[i % 3]) for i in range(600)]
    random.shuffle(rows)
    rows = [(int(i), list(v)) for i, v in rows]
    df = spark.createDataFrame([*rows, (None, copies[0]), (601, None), (602, [None, 1.0, 1.0, 1.0])], "vec_id long, embedding array<float>").coalesce(2)
    found = vectors.cosine_top_k(df, df.where("vec_id % 50 = 0 AND vec_id < 600")).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in found) == brute(rows, 50)


def test_more_queries_than_one_block_and_than_5000(spark):
    random = np.random.default_rng(2)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(random.normal(size=(5200, 4)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    found = vectors.cosine_top_k(df, df, 3).collect()
    assert len(found) == 3 * 5200
    assert sorted((r.query_id, r.rank, r.vec_id) for r in found if r.query_id % 100 == 0) == brute(rows, 100, 3)
    assert vectors.cosine_top_k(df.where("false"), df).count() == 0
