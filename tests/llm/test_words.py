import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

from codalith.llm import common, merge_dropout, packing, substring, token_counts, toxicity, words

from cases import documents


def thue_morse(n):
    a, b = "a", "b"
    while len(a) < n:
        a, b = a + b, b + a
    return a, b


PAIRS = [thue_morse(n) for n in (8, 64, 1024, 4096)]


@pytest.mark.parametrize("pair", PAIRS)
def test_structured_words_have_different_hashes(pair):
    data, offsets = common.utf8(pa.array([" ".join([*pair, pair[0]])]))
    starts, ends, _ = words.bounds(data, offsets)
    for seed in (0, 1):
        h = words.hashes(data, starts, ends, seed)
        assert h[0] == h[2] != h[1]


def few_hashes(monkeypatch):
    """Every word gets one of three hashes by each of the first seeds."""
    real = words.hashes
    monkeypatch.setattr(words, "hashes", lambda data, starts, ends, seed=0, step=1 << 16: real(data, starts, ends, seed) % np.uint64(3 if seed < 3 else 1 << 63))


def test_a_pool_compares_bytes(monkeypatch):
    few_hashes(monkeypatch)
    texts = [f"w{k} x{k * k} " + "y" * k + " same" for k in range(120)]
    pool = words.SlicePool(np.uint8)
    for batch in (texts[:50], texts, texts[::-1]):
        data, offsets = common.utf8(pa.array(batch))
        starts, ends, _ = words.bounds(data, offsets)
        make = lambda new: (words.gather(data, starts[new], ends[new] - starts[new]), ends[new] - starts[new])  # noqa: B023, E731
        begin, length = pool.look_up(data, starts, ends, make)
        assert words.gather(pool.pool, begin, length).tobytes().decode() == "".join("".join(t.split()) for t in batch)
        exact = words.exact(data, starts, ends)
        assert len(set(exact.tolist())) == len({w for t in batch for w in t.split()})


def test_a_full_pool_starts_anew():
    pool = words.SlicePool(np.int64, limit=10)
    for k in range(20):
        data, offsets = common.utf8(pa.array([f"a{k} b{k} c{k} d{k} e{k}"]))
        starts, ends, _ = words.bounds(data, offsets)
        begin, _ = pool.look_up(data, starts, ends, lambda new: (np.arange(len(new)) + 100 * k, np.ones(len(new), np.int64)))  # noqa: B023
        assert len(pool.pool) <= 15 and sorted(pool.pool[begin].tolist()) == [100 * k + x for x in range(5)]


def test_tokenizers_on_structured_and_colliding_words(monkeypatch):
    tokenizers = pytest.importorskip("tokenizers")
    texts = [" ".join(p) for p in PAIRS] + ["some plain words and numbers 12 and some plain words"]
    for collide in (False, True):
        if collide:
            few_hashes(monkeypatch)
        path = packing.default_tokenizer()
        library = tokenizers.Tokenizer.from_file(path)
        assert [x.tolist() for x in packing.WordTokenizer(path).ids(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        coder = merge_dropout.MergeCoder(merge_dropout.default_model(), rate=0.2)
        ids, edges, _, _ = coder.encode(texts, np.arange(len(texts)))
        assert [coder.decode(ids[a:b]) for a, b in zip(edges[:-1], edges[1:])] == texts
        pieces = token_counts.read_pieces(token_counts.default_vocabulary())
        together = token_counts.ViterbiCounter(pieces).texts(texts)
        alone = [token_counts.ViterbiCounter(pieces).texts([t]) for t in texts]
        assert together[0].tolist() == [n[0] for n, _ in alone]
        model = toxicity.OrdinalModel({w: 0.01 * k for k, w in enumerate("some plain words numbers and".split())}, (0.1,))
        assert np.allclose(toxicity.Scorer(model).column(pa.array(texts)), [model.severity(t) for t in texts])


@pytest.mark.parametrize("pair", PAIRS)
def test_windows_of_structured_words(spark, pair):
    head = [f"h{k}" for k in range(12)]
    docs = documents(spark, [(1, " ".join([*head, pair[0]])), (2, " ".join([*head, pair[1]])), (3, " ".join([*head, pair[0]]))])
    assert {r.doc_id: r.n_removed for r in substring.dedup_substrings(docs).collect()} == {1: 0, 2: 0, 3: 13}


def test_one_word_of_50_mb():
    code = """
import numpy as np, resource
from codalith.llm import words
data = np.full(50 << 20, 97, np.uint8); data[1000] = 32
starts, ends, _ = words.bounds(data, np.array([0, len(data)]))
assert len(words.hashes(data, starts, ends)) == 2
pool = words.SlicePool(np.int64)
pool.look_up(data, starts, ends, lambda new: (np.ones(len(new), np.int64), np.ones(len(new), np.int64)))
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    assert int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout) < 1000


def test_first_owners_of_equal_hashes():
    random = np.random.default_rng(1)
    for _ in range(30):
        n = 60
        records = (random.integers(0, 6, n).astype(np.uint64), random.integers(0, 3, n).astype(np.uint8), random.integers(0, 5, n), random.integers(0, 2, n).astype(np.uint16))
        rows = list(zip(*(x.tolist() for x in records)))
        least = {}
        for h, second, doc, _ in rows:
            least[h, second] = min(doc, least.get((h, second), doc))
        kept, lost = substring.first_owners(records)
        assert {rows[k] for k in kept} == {r for r in rows if r[2] == least[r[0], r[1]]}
        assert sorted(lost.tolist()) == [k for k, r in enumerate(rows) if r[2] > least[r[0], r[1]]]
        again = substring._unpack(b"".join(x for _, x in substring._pack(np.zeros(n, np.int64), records)))
        assert sorted(zip(*(x.tolist() for x in again))) == sorted(rows)
