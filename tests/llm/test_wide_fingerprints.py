"""The near-dup stage of the pipeline finds its candidates by SimHash fingerprints and pivots."""

import numpy as np
import pytest

import corpus_pipeline
from codalith.llm import shingles, simhash, words

from cases import documents


def pair_of_sets(random, a, b, both):
    v = words.mix(random.integers(0, 1 << 62, a + b - both).astype(np.uint64))
    return v[:a], v[a - both :]


def fingerprints(members, n_words):
    edges = np.r_[0, np.cumsum([len(x) for x in members])]
    return shingles.fingerprints(np.concatenate([np.sort(x) for x in members]), edges, n_words)


def all_links(fp, size, percent=80):
    small, large = shingles.bit_limits(percent)
    out = []
    for i in range(len(size)):
        for j in range(i):
            low, high = sorted((size[i], size[j]))
            if 100 * low >= percent * high and np.bitwise_count(fp[:, i] ^ fp[:, j]).sum() <= (small if low < shingles.SMALL else large):
                out.append((j, i))
    return tuple(np.array(x, np.int64) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 2


def test_a_fingerprint_has_the_bits_of_more_than_half_of_the_hashes():
    random = np.random.default_rng(1)
    members = [words.mix(random.integers(0, 1 << 62, n).astype(np.uint64)) for n in (1, 0, 4, 255, 256, 9000, 3)]
    found = fingerprints(members, 3)
    salts = words._splitmix(3, 17)
    for v, own in zip(members, found):
        assert own.tolist() == [simhash.fingerprint(words.mix(np.sort(v) ^ salt)) for salt in salts]


def test_keys_hold_their_own_bits():
    fp = np.random.default_rng(2).integers(0, 1 << 62, (5, 12)).astype(np.uint64)
    keys = shingles.band_keys(fp, 9, 50)
    for row, own in zip(fp.tolist(), keys.tolist()):
        whole = sum(x << 64 * k for k, x in enumerate(row))
        assert own == [(band << shingles.MOST_BITS) + (whole >> shingles.COMPARED + 9 * band & 511) for band in range(50)]


@pytest.mark.parametrize("a, b, both", [(4, 5, 4), (5, 6, 5), (12, 15, 12), (90, 90, 80), (160, 200, 160)])
@pytest.mark.parametrize("rows", [1000, 30_000_000])
def test_pairs_at_the_similarity_are_candidates(a, b, both, rows):
    random = np.random.default_rng(3)
    bits, bands = shingles.band_plan(rows)
    pairs = [pair_of_sets(random, a, b, both) for _ in range(1000)]
    fp = fingerprints([x for pair in pairs for x in pair], -(-(shingles.COMPARED + bits * bands) // 64))
    one, other = fp[::2], fp[1::2]
    shared = (shingles.band_keys(one, bits, bands) == shingles.band_keys(other, bits, bands)).any(axis=1)
    differ = np.bitwise_count(one[:, : shingles.COMPARED_WORDS] ^ other[:, : shingles.COMPARED_WORDS]).sum(axis=1)
    assert (~shared).sum() <= 2 and (differ <= shingles.bit_limits()[a >= shingles.SMALL]).sum() >= 999
    chance = shingles._bit_differs(a, b, both)
    assert chance <= shingles.bit_chances()[a >= shingles.SMALL] and abs(differ.mean() / shingles.COMPARED - chance) < 0.005


def block(random, groups, alone):
    """Fingerprints of groups of near copies (two groups of them chained) and of unlike members, and ascending sizes."""
    rows = []
    for n, most in groups:
        base = random.integers(0, 1 << 63, 4).astype(np.uint64)
        for _ in range(n):
            own = base.copy()
            for place in random.choice(256, random.integers(0, most), replace=False):
                own[place // 64] ^= np.uint64(1 << int(place) % 64)
            rows.append(own)
    rows += [random.integers(0, 1 << 63, 4).astype(np.uint64) for _ in range(alone)]
    fp = np.array(rows)[random.permutation(len(rows))]
    return np.ascontiguousarray(fp.T), np.sort(random.integers(4, 40, len(rows)))


@pytest.mark.parametrize("groups, alone", [([], 0), ([], 150), ([(20, 60)], 30), ([(300, 20)], 200), ([(200, 90), (150, 70), (3, 5)], 100)])
def test_edges_of_a_block_connect_what_all_pairs_connect(groups, alone):
    fp, size = block(np.random.default_rng(4), groups, alone)
    found = shingles.fingerprint_edges(fp, size)
    links = all_links(fp, size)
    assert (simhash._stars(len(size), *found) == simhash._stars(len(size), *links)).all()
    assert set(zip(*np.sort(np.array(found), axis=0).tolist())) <= set(zip(*(x.tolist() for x in links)))


def test_pivots_spare_a_large_group_its_pairs(monkeypatch):
    fp, _ = block(np.random.default_rng(5), [(4000, 20)], 400)
    size, compared, plain = np.full(4400, 30), [], shingles._distances
    monkeypatch.setattr(shingles, "_distances", lambda fp, r, c: (compared.append(len(r) * len(c)), plain(fp, r, c))[1])
    found = shingles.fingerprint_edges(fp, size)
    assert np.bincount(simhash._stars(4400, *found)).max() == 4000
    assert sum(compared) < 4400 * 4399 / 2 / 10


def test_the_stage_goes_by_fingerprints(spark, monkeypatch):
    """Without links of fingerprints nothing but equal sets is removed, so nothing beside them finds pairs."""
    text = " ".join(f"w{k}" for k in range(100))
    docs = documents(spark, [(1, text), (2, text + " more"), (3, text), (4, "one two")])
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [1, 4]
    monkeypatch.setattr(shingles, "candidate_links", lambda nodes, *_: nodes.selectExpr("node AS a", "node AS b").limit(0))
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [1, 2, 4]
