import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from codalith.llm import common, labelled, merge_dropout, packing, quality_ranking, quality_rules, simhash, substring, textstats, token_counts, toxicity, words

from cases import TEXTS, documents, empty


def raw_words(text):
    return (text or "").encode().split()


def test_words_and_hashes():
    texts = ["a b  c", " x\ny ", "", "abc abc", "é è\x0bq\x1cz"]
    data, offsets = common.utf8(pa.array(texts))
    starts, ends, first = words.bounds(data, offsets)
    assert [bytes(data[a:b]) for a, b in zip(starts, ends)] == [w for t in texts for w in t.encode().split()]
    assert np.diff(first).tolist() == [len(t.encode().split()) for t in texts]
    h = words.hashes(data, starts, ends)
    assert h[5] == h[6] and len(set(h.tolist())) == len(h) - 1


def removed_by_brute_force(texts, width=13):
    first = {}
    for d, t in texts:
        w = raw_words(t)
        for k in range(len(w) - width + 1 if d is not None else 0):
            key = tuple(w[k : k + width])
            first[key] = min(d, first.get(key, d))
    out = []
    for d, t in texts:
        w, gone = raw_words(t), set()
        for k in range(len(w) - width + 1 if d is not None else 0):
            if first[tuple(w[k : k + width])] < d:
                gone.update(range(k, k + width))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def test_substring_dedup(spark):
    found = substring.dedup_substrings(documents(spark)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found), key=str) == removed_by_brute_force(TEXTS)
    row = next(r for r in found if r.doc_id == 2)
    assert [tuple(x) for x in row.removed] == [(5, 24)] and row.kept_text == "other words come first here and others last"


def test_substring_stage_keeps_columns(spark):
    docs = documents(spark)
    out = substring.remove_substrings(docs)
    assert out.schema == docs.schema
    by_id = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    assert by_id[7].text == "" and by_id[7].n_chars == 0 and by_id[6].text == TEXTS[5][1] and by_id[3].text is None
    assert out.count() == len(TEXTS)
    assert substring.remove_substrings(empty(spark)).count() == 0 and substring.dedup_substrings(empty(spark)).count() == 0


def fingerprint_by_brute_force(text, shingle=3):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[k : k + shingle]) for k in range(len(w) - shingle + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def components_by_brute_force(texts):
    fp = [fingerprint_by_brute_force(t) for _, t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if (fp[a] ^ fp[b]).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for k, (d, _) in enumerate(texts):
        if d is not None:
            least[find(k)] = min(d, least.get(find(k), d))
    return sorted(((d, f"{fp[k]:016x}", least.get(find(k))) for k, (d, _) in enumerate(texts)), key=str)


def test_simhash(spark):
    found = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(documents(spark)).collect()]
    assert sorted(found, key=str) == components_by_brute_force(TEXTS)
    assert simhash.near_duplicates(empty(spark)).count() == 0
    docs = documents(spark)
    kept = simhash.keep_first(docs)
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == {1, 2, 3, 6, 9, 10, 12, 13, None} | ({8} if not any(r[0] == 8 and r[2] == 6 for r in found) else set())


@pytest.mark.parametrize("flips", [0, 3, 8])
def test_links_equal_all_pairs(spark, flips):
    random = np.random.default_rng(flips)
    centres = random.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = set()
    for c in centres.tolist():
        for _ in range(150):
            x = c
            for b in random.integers(0, 64 if flips < 8 else 20, random.integers(0, flips + 1)):
                x ^= 1 << int(b)
            fps.add(x)
    values = sorted(fps)
    v = np.array(values, np.uint64)
    close = np.bitwise_count(v[:, None] ^ v[None, :]) <= 2
    label = np.arange(len(v))
    while True:
        new = np.array([label[row].min() for row in close])
        if (new == label).all():
            break
        label = new
    nodes = spark.createDataFrame([(simhash._signed(x),) for x in values], "fp long")
    found = simhash.components(simhash.fingerprint_links(nodes)).collect()
    group = {simhash._signed(x): simhash._signed(x) for x in values} | {r.node: r.root for r in found}
    own, brute = {}, {}
    for k, x in enumerate(values):
        own.setdefault(group[simhash._signed(x)], set()).add(x)
        brute.setdefault(label[k], set()).add(x)
    assert sorted(map(sorted, own.values())) == sorted(map(sorted, brute.values()))


def test_dense_blocks_are_split_exactly(monkeypatch):
    monkeypatch.setattr(simhash, "DENSE", 8)
    random = np.random.default_rng(5)
    fp = np.unique(random.integers(0, 1 << 22, 400, dtype=np.uint64))
    i, j = simhash._dense_links(fp, (1 << 22) - 1, 2)
    close = np.argwhere(np.triu(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 2, 1))
    assert (simhash._stars(len(fp), i, j) == simhash._stars(len(fp), close[:, 0], close[:, 1])).all()


def test_long_chain_of_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    assert {r.node: r.root for r in simhash.components(edges).collect()} == {k: 0 for k in range(1, 61)} | {101: 100}


def test_base_rules(spark):
    model = quality_rules.NgramModel(np.zeros((4, 1 << quality_rules.FAMILY_BITS), np.float32), 0.0, 1.0, 0.0)
    texts = [*TEXTS, (20, " ".join(["a b c d e f g h"] * 5) + " #*$%&|<> end"), (21, "\n".join(["x y", " ", "x y", "x  y", ""] * 3))]
    for r in quality_rules.judge(documents(spark, texts), model).collect():
        t = [t for d, t in texts if d == r.doc_id]
        if r.doc_id is None:
            continue
        text = t[0] or ""
        w = text.encode().split()
        seen, cover = {}, set()
        for k in range(len(w) - 7):
            seen.setdefault(tuple(w[k : k + 8]), []).append(k)
        for at in seen.values():
            if len(at) > 1:
                for k in at:
                    cover.update(range(k, k + 8))
        lines = [x for x in text.split("\n") if x.encode().split()]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(len(x.decode()) for x in w), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover))
        assert r.base_failed == (len(w) < 20 or 100 * len(cover) > 30 * len(w)) and r.kept == (not r.base_failed)
    assert quality_rules.judge(empty(spark), model).count() == 0


def labelled_corpus(spark):
    rows, marks = [], []
    for k in range(400):
        good, toxic = k % 4 != 0, k % 5 == 0
        body = [f"w{(k * 7 + i * i) % 211}" for i in range(60)]
        if not good:
            body = [x + "$$$" for x in body]
        if toxic:
            body[10] = ("badword", "nastyness", "nastyful", "nastyling")[k % 4]
        rows.append((k, " ".join(body)))
        marks.append((k, int(good), int(toxic), "extra"))
    return documents(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int, text string"), {m[0]: m for m in marks}


def held(d):
    return zlib.crc32(str(d).encode()) % 5 == 0


def test_classifiers_on_held_out_rows(spark):
    docs, labels, truth = labelled_corpus(spark)
    ranks = quality_ranking.score(docs, quality_ranking.train(docs, labels)).collect()
    assert all((r.score >= 0.3) == bool(truth[r.doc_id][1]) and 0 <= r.score <= 1 for r in ranks if held(r.doc_id))
    rules = quality_rules.judge(docs, quality_rules.train(docs, labels)).collect()
    assert np.mean([(r.probability >= 0.5) == bool(truth[r.doc_id][1]) for r in rules if held(r.doc_id)]) > 0.97
    model = toxicity.train(docs, labels)
    mild = toxicity.score(docs, model).collect()
    assert all((r.severity >= 0.5) == bool(truth[r.doc_id][2]) for r in mild if held(r.doc_id))
    assert abs(mild[0].severity - model.severity(docs.where(f"doc_id = {mild[0].doc_id}").first().text)) < 1e-9


def test_classifiers_without_labels_and_on_odd_texts(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 1), (1, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, one):
        assert {r.score for r in quality_ranking.score(docs, quality_ranking.train(docs, labels)).collect()} == {0.5}
        assert all(r.kept != r.base_failed for r in quality_rules.judge(docs, quality_rules.train(docs, labels)).collect())
    assert {r.severity for r in toxicity.score(docs, toxicity.train(docs, none)).collect()} == {0.0}
    assert {r.severity for r in toxicity.score(docs, toxicity.train(docs, one)).collect()} == {0.0 if held(1) else 1.0}
    good, labels, _ = labelled_corpus(spark)
    model = quality_ranking.train(good, labels)
    assert quality_ranking.score(docs, model).count() == len(TEXTS) and quality_ranking.keep_good(docs, model).schema == docs.schema
    assert quality_ranking.keep_good(empty(spark), model).count() == 0
    assert toxicity.keep_mild(empty(spark), toxicity.train(good, labels)).count() == 0


def test_ordinal_thresholds_share_weights():
    random = np.random.default_rng(1)
    z = random.normal(size=600) * 2
    grades = np.digitize(z, [-1, 1, 2])
    rows = [{0: max(x, 0.0), 1: max(-x, 0.0)} for x in z]
    w, theta = toxicity.fit(rows, grades, 2)
    assert w[0] > 0 > w[1] and len(theta) == 3 and (np.diff(theta) > 0).all()
    expected = toxicity.OrdinalModel({}, tuple(theta)).expected(np.array([w[0] * r[0] + w[1] * r[1] for r in rows]))
    assert np.corrcoef(expected, grades)[0, 1] > 0.9 and expected.min() >= 0 and expected.max() <= 3


def test_features_do_not_look_at_neighbours():
    data, offsets = common.utf8(pa.array([t or "" for _, t in TEXTS]))
    together = textstats.features(data, offsets)
    for k, (_, t) in enumerate(TEXTS):
        assert np.allclose(together[k], textstats.features(*common.utf8(pa.array([t or ""])))[0])


def test_token_counts_equal_the_tokenizer(spark):
    tokenizers = pytest.importorskip("tokenizers")
    pieces = token_counts.read_pieces(token_counts.default_vocabulary())
    own = tokenizers.Tokenizer(tokenizers.models.Unigram([tuple(p) for p in pieces], unk_id=0, byte_fallback=True))
    own.pre_tokenizer = tokenizers.pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    texts = [*TEXTS, (30, "  a  b "), (31, " "), (32, "a\nb\tc"), (33, "▁x ▁▁y")]
    found = token_counts.count_tokens(documents(spark, texts), token_counts.default_vocabulary()).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in found) == sorted((str(d), len(own.encode(t or "").ids)) for d, t in texts)
    assert token_counts.count_tokens(empty(spark), token_counts.default_vocabulary()).count() == 0


def test_viterbi_ties_stay_with_the_earlier_start():
    counter = token_counts.ViterbiCounter([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", -1.0), ("▁a", -2.0)])
    assert counter.unit("ab") == (1, -2.0) and counter.unit("▁ab") == (2, -3.0)
    assert counter.unit("é") == (2, -12.0)


def test_merge_dropout(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = merge_dropout.default_model()
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = merge_dropout.encode(documents(spark), path, rate=0.0).collect()
    by_text = {d: t for d, t in TEXTS if d is not None}
    assert all(r.ids == library.encode(by_text[r.doc_id] or "") for r in plain if r.doc_id is not None)
    dropped = merge_dropout.encode(documents(spark), path, rate=0.3)
    again = {str(r.doc_id) + str(r.n_ids): r.ids for r in merge_dropout.encode(documents(spark).coalesce(1), path, rate=0.3).collect()}
    rows = dropped.collect()
    assert all(r.lossless == (r.doc_id != 9) and again[str(r.doc_id) + str(r.n_ids)] == r.ids for r in rows)  # 9 holds U+2581
    assert next(r for r in rows if r.doc_id == 6).n_ids > next(r for r in plain if r.doc_id == 6).n_ids
    decoded = {r.doc_id: r.text for r in merge_dropout.decode(dropped, path).collect() if r.doc_id is not None}
    assert all(decoded[d] == (t or "").replace("▁", " ") for d, t in by_text.items())
    other = {r.doc_id: r.ids for r in merge_dropout.encode(documents(spark), path, rate=0.3, seed=4).collect()}
    assert other[6] != next(r for r in rows if r.doc_id == 6).ids
    assert merge_dropout.encode(empty(spark), path).count() == 0


def test_heap_and_arrays_merge_alike(monkeypatch):
    coder = merge_dropout.MergeCoder(merge_dropout.default_model(), rate=0.25)
    units = ["▁" + w for w in TEXTS[5][1].split()[:300]] + ["▁▁▁日本x", "▁naïveté"]
    keys = words.mix(np.arange(len(units), dtype=np.uint64))
    short = coder._encode(units, keys)
    monkeypatch.setattr(merge_dropout, "LONG_UNIT", 0)
    long = coder._encode(units, keys)
    assert np.array_equal(short[0], long[0]) and np.array_equal(short[1], long[1])


def test_packing(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = packing.default_tokenizer()
    library = tokenizers.Tokenizer.from_file(path)
    found = packing.pack(packing.pieces(documents(spark), path)).toPandas()
    want = []
    for d, t in TEXTS:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want.append((str(float(d)) if d is not None else "nan", k, at, len(part), zlib.crc32(part.tobytes())))
    columns = ["piece", "start", "length", "ids_crc32"]
    assert sorted((str(float(r[0])) if r[0] == r[0] and r[0] is not None else "nan", *r[1:]) for r in found[["doc_id", *columns]].itertuples(index=False)) == sorted(want)
    for _, group in found.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert group["offset"].tolist() == np.r_[0, np.cumsum(group["length"])][:-1].tolist() and group["length"].sum() <= 2048
    assert packing.pack(packing.pieces(empty(spark), path)).count() == 0


def test_plan_uses_each_length_once_and_replaces_by_two():
    assert packing.plan_patterns({60: 1, 30: 1, 25: 1, 15: 1}, 100) == [((60, 25, 15), 1), ((30,), 1)]
    random = np.random.default_rng(3)
    histogram = {int(k): int(n) for k, n in enumerate(random.integers(0, 400, 2048)) if k and n}
    plan = packing.plan_patterns(histogram)
    used = {}
    for lengths, n in plan:
        assert sum(lengths) <= 2048
        for x in lengths:
            used[x] = used.get(x, 0) + n
    assert used == histogram


def first_fit_decreasing(lengths, capacity=2048):
    free = []
    for x in sorted(lengths, reverse=True):
        k = next((k for k, f in enumerate(free) if f >= x), None)
        if k is None:
            free.append(capacity - x)
        else:
            free[k] -= x
    return len(free)


@pytest.mark.parametrize("kind", ["uniform", "short", "medium", "equal"])
def test_plan_needs_no_more_sequences_than_first_fit_decreasing(kind):
    random = np.random.default_rng(8)
    draw = {"uniform": lambda: random.integers(1, 2049, 1500), "short": lambda: np.clip(random.lognormal(5.5, 1, 1500).astype(int), 1, 2048), "medium": lambda: random.integers(500, 1100, 1500), "equal": lambda: np.full(1500, 700)}
    lengths = draw[kind]().tolist()
    n = sum(n for _, n in packing.plan_patterns({x: lengths.count(x) for x in set(lengths)}))
    assert sum(lengths) / 2048 <= n <= first_fit_decreasing(lengths)


def test_word_tokenizer_is_exact():
    tokenizers = pytest.importorskip("tokenizers")
    path = packing.default_tokenizer()
    library = tokenizers.Tokenizer.from_file(path)
    odd = ["ΑΣ ΣΑΣ. Σ", "a\x1cb c\x85d\xa0e", "<|endoftext|> hi", "", "it's 'll I'M don't 12a34 ab,! x.,, İx é́ ́a ½ ª", "o'd. 's. d't,", "foo　bar baz﻿q"]
    texts = [*odd, *[t for _, t in TEXTS if t]]
    own = packing.WordTokenizer(path)
    for _ in range(2):
        assert [x.tolist() for x in own.ids(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_pipeline_stages_equal_their_operators(spark, tmp_path):
    import corpus_pipeline

    docs, labels, truth = labelled_corpus(spark)
    extra = [(1000 + k, t) for k, (_, t) in enumerate(TEXTS) if t and len(t) > 200]
    docs = docs.union(documents(spark, extra)).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.drop("text").write.parquet(f"{tmp_path}/labels.parquet")
    table = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = common.stage_table(stage(spark, table, str(tmp_path)), name)
        assert table.columns == docs.columns
    texts = {r.doc_id: r.text for r in table.collect()}
    assert not any(d in texts for d, m in truth.items() if not m[1] or m[2])
    assert sum(len(t.split()) for t in texts.values()) > 0
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in result} == set(texts)
