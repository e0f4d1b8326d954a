"""Trained models against their definitions, computed plainly."""

import math

import numpy as np
import pytest

from codalith.llm import common, labelled, merge_dropout, quality_ranking, quality_rules, toxicity, words

from cases import TEXTS, documents


def test_ranking_minimises_the_loss_of_all_pairs():
    random = np.random.default_rng(3)
    good, bad = random.normal(0.4, 1, (40, 5)), random.normal(0, 1, (30, 5))

    def loss(w):
        pairs = [math.log1p(math.exp(-float(w @ (g - b)))) for g in good for b in bad]
        return 1000 * sum(pairs) / len(pairs) + 0.5 * float(w @ w)

    w = quality_ranking.pair_weights(good, bad, l2=1.0)
    least = loss(w)
    for k in range(5):
        for step in (-0.01, 0.01):
            moved = w.copy()
            moved[k] += step
            assert loss(moved) > least
    assert not quality_ranking.pair_weights(good, good).any()


def test_the_threshold_is_the_best_quantile():
    random = np.random.default_rng(5)
    y = np.r_[np.ones(40, int), np.zeros(25, int)]
    score = np.where(y == 1, random.normal(1, 1, 65), random.normal(-1, 1, 65)).round(1)
    balanced = lambda t: ((score >= t) & (y == 1)).sum() / 40 + ((score < t) & (y == 0)).sum() / 25
    found = labelled.separating_threshold(score, y)
    assert balanced(found) == max(balanced(t) for t in np.arange(-5, 5, 0.01))


def probability(model, text):
    """The score of one text by plain numbers."""
    raw = (text or "").encode()
    data, offsets = common.utf8(common.pa.array([text or ""]))
    starts, ends, _ = words.bounds(data, offsets)
    h = [int(x) for x in words.hashes(data, starts, ends)]
    mix = lambda x: int(words.mix(np.array([x % 2**64], np.uint64))[0])
    base, top = 0x9E3779B97F4A7C15, 64 - quality_rules.FAMILY_BITS
    slots = [[mix(x) >> top for x in h], [mix(a * base + b) >> top for a, b in zip(h, h[1:])]]
    codes = [ord(c) + 1 for c in raw.decode()]
    for width in (3, 4):
        own = []
        for k in range(len(codes) - width + 1):
            gram = 0
            for c in codes[k : k + width]:
                gram = (gram * base + c) % 2**64
            own.append(gram * 0xBF58476D1CE4E5B9 % 2**64 >> top)
        slots.append(own)
    z = sum(sum(float(model.weights[f][s]) for s in own) / max(1, len(own)) for f, own in enumerate(slots))
    return 1 / (1 + math.exp(-(model.slope * z + model.shift)))


def noisy_corpus(spark, rates, n=1200):
    """Kinds of texts whose labels are 1 at a given rate each."""
    random = np.random.default_rng(9)
    rows, marks = [], []
    for k in range(n):
        kind = k % len(rates)
        rows.append((k, " ".join(f"{'aeiou'[kind]}{x}" for x in random.integers(0, 40, 30)) + " ünï"))
        marks.append((k, int(random.random() < rates[kind])))
    return documents(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int"), rows


def test_quality_probability_is_calibrated_and_plainly_computed(spark):
    rates = (0.95, 0.8, 0.4)
    docs, labels, rows = noisy_corpus(spark, rates)
    model = quality_rules.train(docs, labels, per_class=2000)
    texts = dict(rows)
    found = {r.doc_id: r for r in quality_rules.judge(docs, model).collect()}
    unseen = [k for k in texts if labelled.zlib.crc32(str(k).encode()) % labelled.FOLDS == 0]
    marks = {r.doc_id: r.quality for r in labels.collect()}
    for part in np.array_split(sorted(unseen, key=lambda k: found[k].probability), 3):  # of rows with like scores as many are good as the scores say
        assert abs(np.mean([found[k].probability for k in part]) - np.mean([marks[k] for k in part])) < 0.15
    few = quality_rules.train(docs, labels, per_class=150)  # the sample has as many rows of either label, the corpus hasn't
    by_few = {r.doc_id: r.probability for r in quality_rules.judge(docs, few).collect()}
    assert abs(np.mean([by_few[k] for k in unseen]) - np.mean(rates)) < 0.1
    odd = documents(spark, TEXTS)
    by_id = {d: t for d, t in TEXTS if d is not None}
    for r in [*quality_rules.judge(odd, model).collect(), *found.values()][:60]:
        if r.doc_id is not None:
            text = by_id.get(r.doc_id) if r.doc_id in by_id and r not in found.values() else texts[r.doc_id]
            assert abs(r.probability - probability(model, text)) < 1e-4
            assert r.kept == (not r.base_failed and r.probability >= quality_rules.KEEP)


def test_labelled_sample_holds_one_row_per_document(spark):
    docs = documents(spark, [(1, "b"), (1, "a"), *[(2, f"t{k}") for k in range(50)], (3, None), (None, "x")])
    labels = spark.createDataFrame([(d, 1) for d in (1, 1, 2, 3, 4)] + [(None, 1), (6, None)], "doc_id long, quality int")
    rows = {r.doc_id: r.text for r in labelled.sample(docs, labels, "quality", 10).collect()}
    usable = {d for d in (1, 2, 3) if not labelled.zlib.crc32(str(d).encode()) % labelled.FOLDS == 0}
    assert rows == {d: {1: "a", 2: "t0", 3: None}[d] for d in usable}


def test_cumulative_links_are_at_their_best():
    random = np.random.default_rng(1)
    grades = random.integers(0, 4, 200)
    features = [{int(k): float(random.random() + (g if k == 0 else 0)) for k in random.choice(3, 2, replace=False)} for g in grades]
    w, theta = toxicity.fit(features, grades, 3, rounds=3000)
    count = np.bincount(grades, minlength=4)

    def loss(w, theta):
        total = 0.0
        for f, g in zip(features, grades.tolist()):
            z = sum(w[k] * v for k, v in f.items())
            above = [1.0, *(1 / (1 + math.exp(-(z - t))) for t in theta), 0.0]
            total -= math.log(max(above[g] - above[g + 1], 1e-12)) / (count[g] * 4)
        return total + 0.5 * 1e-3 * float(w @ w) / len(features)

    least = loss(w, theta)
    for k in range(3):
        for step in (-0.05, 0.05):
            assert loss(w + step * (np.arange(3) == k), theta) > least - 1e-6 and loss(w, theta + step * (np.arange(3) == k)) > least - 1e-6
    model = toxicity.OrdinalModel({}, tuple(theta), lowest=1)
    expected = model.expected(np.array([0.3]))[0]
    masses = np.diff([0.0, *(1 - 1 / (1 + np.exp(-(0.3 - theta)))), 1.0])
    assert abs(expected - sum((1 + g) * p for g, p in enumerate(masses))) < 1e-9


def naive(coder, text, key):
    """Symbols merged one by one: of all candidates that aren't dropped the highest score, and of these the leftmost."""
    parts = [(coder.number.get(c, -1), k, k + 1) for k, c in enumerate(text)]
    while True:
        best = None
        for k, ((a, left, middle), (b, _, right)) in enumerate(zip(parts, parts[1:])):
            piece = coder.pair_dict.get(a << 32 | b) if a >= 0 and b >= 0 else None
            if piece is None or coder.rate and coder._skipped(np.array([key], np.uint64), np.array([left]), np.array([middle]), np.array([right]))[0]:
                continue
            if best is None or coder.score[piece] > best[0]:
                best = coder.score[piece], k, piece
        if best is None:
            return [x for s, a, b in parts for x in coder._ids(s, text[a:b])]
        _, k, piece = best
        parts[k : k + 2] = [(piece, parts[k][1], parts[k + 1][2])]


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5, 1.0])
def test_merges_equal_one_by_one_merging(rate):
    pytest.importorskip("sentencepiece")
    coder = merge_dropout.MergeCoder(merge_dropout.default_model(), rate=rate)
    units = ["▁" + w for w in TEXTS[5][1].split()[:60]] + ["▁▁▁日本x", "▁naïveté", "▁" + "abcabc" * 12, "▁", "𝒳y"]
    keys = words.mix(np.arange(len(units), dtype=np.uint64) + np.uint64(5))
    ids, lengths = coder._encode(units, keys)
    edges = np.r_[0, np.cumsum(lengths)]
    for k, unit in enumerate(units):
        order = [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:])][k]
        assert order == naive(coder, unit, int(keys[k])), unit


def test_pair_table_finds_what_it_holds():
    random = np.random.default_rng(2)
    keys = np.unique(random.integers(0, 1 << 45, 5000))
    table = merge_dropout.PairTable(keys, np.arange(len(keys)))
    assert np.array_equal(table.find(keys), np.arange(len(keys)))
    other = np.setdiff1d(random.integers(0, 1 << 45, 5000), keys)
    assert (table.find(np.r_[other, -1]) == -1).all()
