"""Records of repeated windows: one for each window, doc_id and route, however often rows repeat."""

import numpy as np

from codalith.llm import substring


def records(h, docs, route):
    n = len(h)
    return np.array(h, np.uint64), np.zeros(n, np.uint8), np.array(docs, np.int64), np.array(route, np.uint16)


def test_one_doc_id_in_very_many_rows_keeps_one_record_a_route():
    n = 100_000
    kept, lost = substring.first_owners(records([7] * n, [5] * n, np.arange(n) % 2))
    assert len(kept) == 2 and len(lost) == 0


def test_one_loss_for_very_many_rows_of_one_text():
    n = 100_000
    kept, lost = substring.first_owners(records([7] * n, [1] + [5] * (n - 1), [0] * n))
    assert kept.tolist() == [0] and len(lost) == 1 and lost[0] > 0


def test_losses_are_those_of_brute_force():
    random = np.random.default_rng(2)
    for _ in range(50):
        n = 300
        h, docs, route = random.integers(0, 20, n), random.integers(-3, 6, n), random.integers(0, 3, n)
        kept, lost = substring.first_owners(records(h, docs, route))
        least = {w: docs[h == w].min() for w in h.tolist()}
        assert sorted(zip(h[lost].tolist(), docs[lost].tolist(), route[lost].tolist())) == sorted({(w, d, r) for w, d, r in zip(h.tolist(), docs.tolist(), route.tolist()) if d > least[w]})
        several = {w: len({r for x, d, r in zip(h.tolist(), docs.tolist(), route.tolist()) if x == w and d == least[w]}) for w in least}
        assert sorted(h[kept].tolist()) == sorted(w for w, k in several.items() for _ in range(k)) and all(docs[k] == least[h[k]] for k in kept.tolist())


def test_a_part_tells_each_loss_once():
    """What several blocks have told about one document is reduced while it is read."""
    import pyarrow as pa

    width = 40_000
    h = np.arange(width, dtype=np.uint64)
    raw = [r for _, r in substring._pack(np.zeros(width, np.int64), (h, np.zeros(width, np.uint8), np.full(width, 9), np.full(width, 3, np.uint16)))] * 120
    batches = (pa.RecordBatch.from_arrays([pa.array([0] * 10), pa.array(raw[k : k + 10], pa.binary())], ["bucket", "records"]) for k in range(0, 120, 10))
    (out,) = list(substring._gather(batches))
    assert out.column("doc_id").to_pylist() == [9] and len(out.column("hits")[0].as_py()) == 8 * width
