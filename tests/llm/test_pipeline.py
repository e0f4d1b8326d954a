"""The registered queries and the whole pipeline against plain Python, on awkward rows."""

import hashlib
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from codalith.llm import common, packing, quality_ranking, toxicity

from cases import TEXTS, documents, empty
from test_shingles import edited, kept_by_brute_force
from test_text_operators import components_by_brute_force, labelled_corpus, removed_by_brute_force

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def tables(spark, folder, docs, labels):
    docs.select(*COLUMNS).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    """Labelled rows, null and empty texts, repeated rows, copies, and texts that share passages."""
    good, labels, _ = labelled_corpus(spark)
    texts = [(r.doc_id, r.text) for r in good.collect()]
    extra = [(None if d is None else 10_000 + d, t) for d, t in TEXTS] + [(20_000 + d, t) for d, t in edited(6)]
    extra += [(texts[7][0], texts[7][1]), (30_000, texts[9][1]), (30_001, texts[11][1] + " " + texts[13][1])]
    folder = tables(spark, tmp_path_factory.mktemp("awkward"), documents(spark, texts + extra), labels.drop("text"))
    return folder, texts + extra


def pieces_by_brute_force(texts):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(packing.default_tokenizer())
    out = []
    for d, t in texts:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        out += [(str(d), k, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())) for k, at in enumerate(range(0, len(ids), 2048))]
    return sorted(out)


def packed(rows):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        ends = np.cumsum([n for _, n in sorted(parts)]).tolist()
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048
    return sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows)


def cut(text, doc_id, rows):
    """text without the words of windows that start in a document of smaller id, and the white space behind them."""
    raw = (text or "").encode()
    words = raw.split()
    if doc_id is None or len(words) < 13:
        return text
    earlier = {tuple(w[k : k + 13]) for d, w in rows if d is not None and d < doc_id for k in range(len(w) - 12)}
    gone = {x for k in range(len(words) - 12) if tuple(words[k : k + 13]) in earlier for x in range(k, k + 13)}
    if not gone:
        return text
    starts, at = [], 0
    for w in words:
        at = raw.index(w, at)
        starts.append(at)
        at += len(w)
    starts.append(len(raw))
    return (raw[: starts[0]] + b"".join(raw[starts[k] : starts[k + 1]] for k in range(len(words)) if k not in gone)).decode()


def test_the_pipeline_equals_plain_python(spark, awkward):
    folder, texts = awkward
    docs, labels = common.table(spark, folder, "documents"), common.table(spark, folder, "labels")
    ranker = quality_ranking.train(docs, labels)
    kept = [(d, t) for d, t in texts if quality_ranking.column_scores(common.pa.array([t], common.pa.string()), ranker)[0] >= 0.3]
    stage = common.stage_table(corpus_pipeline.quality_classifier(spark, docs, folder), "test")
    assert sorted(map(str, kept)) == sorted(str((r.doc_id, r.text)) for r in stage.collect())
    model = toxicity.train(stage, labels)
    kept = [(d, t) for d, t in kept if model.severity(t) < 0.5]
    survivors = kept_by_brute_force(kept)
    kept = [(d, t) for d, t in kept if d is None or d in survivors]
    split = [(d, (t or "").encode().split()) for d, t in kept]
    want = pieces_by_brute_force([(d, cut(t, d, split)) for d, t in kept])
    assert packed(entry.queries()["pipeline"](spark, folder).collect()) == want and len(want) > 100


def test_the_pipeline_on_no_rows_and_without_labels(spark, tmp_path, awkward):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    folder = tables(spark, tmp_path / "none", empty(spark), none)
    assert entry.queries()["pipeline"](spark, folder).count() == 0
    texts = [(d, t) for d, t in TEXTS if d != 13]
    folder = tables(spark, tmp_path / "unlabelled", documents(spark, texts), none)  # nothing is rejected without labels
    survivors = kept_by_brute_force(texts)
    kept = [(d, t) for d, t in texts if d is None or d in survivors]
    split = [(d, (t or "").encode().split()) for d, t in kept]
    assert packed(entry.queries()["pipeline"](spark, folder).collect()) == pieces_by_brute_force([(d, cut(t, d, split)) for d, t in kept])


def test_registered_queries_on_awkward_rows(spark, awkward):
    folder, texts = awkward
    queries = entry.queries()
    rows = queries["op3_substring_dedup"](spark, folder).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=str) == removed_by_brute_force(texts)
    rows = queries["op10_simhash"](spark, folder).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in rows), key=str) == components_by_brute_force(texts)
    assert packed(queries["op8_best_fit_packing"](spark, folder).collect()) == pieces_by_brute_force(texts)
    for name in ("op2_quality_rules", "op5_quality_classifier", "op6_token_counts", "op7_toxicity", "op9_merge_dropout"):
        assert sorted(str(r.doc_id) for r in queries[name](spark, folder).collect()) == sorted(str(d) for d, _ in texts), name
    for r in queries["op5_quality_classifier"](spark, folder).collect():
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_many_rows_of_one_doc_id(spark):
    """Rows that share a doc_id don't remove each other's words, and each loses what an earlier document holds."""
    from codalith.llm import substring

    passage = " ".join(f"p{k}" for k in range(20))
    texts = [(1, passage + " tail")] + [(5, f"head {k} {passage} x{k}") for k in range(300)] + [(5, None)] * 50 + [(None, passage)] * 200 + [(5, f"own {k % 3} " + " ".join(f"q{j}" for j in range(14))) for k in range(60)]
    rows = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring.dedup_substrings(documents(spark, texts), with_text=False).collect()]
    assert sorted(rows, key=str) == removed_by_brute_force(texts)
    assert hashlib.sha256(b"").hexdigest() in {r[3] for r in rows}
