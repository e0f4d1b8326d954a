import numpy as np
import pyarrow as pa

from codalith.llm import simhash


def test_the_pivot_table_discards_most_candidates_and_no_link():
    random = np.random.default_rng(6)
    mask = np.uint64(simhash.MASKS[0])
    base = random.integers(0, 1 << 63, 300, dtype=np.uint64)
    other = (base & mask) | (random.integers(0, 1 << 63, 300, dtype=np.uint64) & ~mask)  # share four bands, as candidates do
    other[:100] = base[:100] ^ (np.uint64(1) << random.integers(0, 64, 100, dtype=np.uint64)) ^ (np.uint64(1) << random.integers(0, 64, 100, dtype=np.uint64))
    fp = np.r_[base, other]
    table = np.bitwise_count(fp[None, :] ^ simhash.pivots()[:, None]).astype(np.int8)
    i, j = np.arange(300), np.arange(300, 600)
    worst = np.abs(table[:, i].astype(int) - table[:, j]).max(axis=0)
    near = np.bitwise_count(fp[i] ^ fp[j]) <= 2
    assert near[:100].all() and (worst[near] <= 2).all()
    assert (worst[~near] > 2).mean() > 0.95
    assert (simhash._near(fp, i, j, table, 2) == near).all()


def test_a_run_over_many_batches_is_one_block():
    random = np.random.default_rng(7)
    fp = np.unique(random.integers(0, 1 << 20, 900, dtype=np.int64))
    n = len(fp)
    columns = [np.zeros(n, np.int8), np.where(np.arange(n) < n - 5, 7, 8), fp]
    batches = [pa.RecordBatch.from_arrays([pa.array(c[at : at + 50]) for c in columns], ["mask_no", "key", "fp"]) for at in range(0, n, 50)]
    whole = [pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["mask_no", "key", "fp"])]
    edges = lambda given: sorted(set(zip(*(np.concatenate([b.column(c).to_numpy() for b in simhash._block_edges(2)(iter(given))]).tolist() for c in ("a", "b")))))
    assert edges(batches) == edges(whole) != []
