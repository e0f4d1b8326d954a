import json

import pytest
from pyspark.sql import functions as F

from codalith.operators import classifiers, clients, selection
from codalith.sources import configuration, encrypted


def test_words_rules_and_settings(spark, tmp_path):
    (tmp_path / "words.json").write_text(json.dumps(["de", "la", "été", "de"]))
    (tmp_path / "rules.yaml").write_text("rules:\n  - pattern: 'courses?'\n    code: '98.1'\n  - pattern: 'drive'\n    code: 98.2\n")
    assert configuration.read_words(spark, str(tmp_path / "words.json")) == ["de", "la", "été"]
    pytest.importorskip("yaml")
    assert configuration.read_rules(spark, str(tmp_path / "rules.yaml")) == [("courses?", "98.1"), ("drive", "98.2")]
    settings = {"llm": {"model": "a", "size": 1}}
    changed = configuration.overridden(settings, {"model": "b", "size": None, "k": 3}, {"model": "llm.model", "size": "llm.size", "k": "retrieval.k"})
    assert changed == {"llm": {"model": "b", "size": 1}, "retrieval": {"k": 3}} and settings["llm"]["model"] == "a"
    assert configuration.object_store_options("k", "s", "http://x")["spark.hadoop.fs.s3a.endpoint"] == "http://x"
    (tmp_path / "bad.json").write_text("{}")
    with pytest.raises(ValueError):
        configuration.read_words(spark, str(tmp_path / "bad.json"))


def test_encrypted_tables(spark, tmp_path):
    rows = [(k, f"text {k}", [k, k + 1], None if k % 3 else 0.5) for k in range(50)]
    df = spark.createDataFrame(rows, "id long, text string, list array<long>, x double").repartition(3)
    path, key = str(tmp_path / "secret"), b"0123456789abcdef0123456789abcdef"
    assert encrypted.write_encrypted(df, path, key) == 50
    back = encrypted.read_encrypted(spark, path, key)
    assert back.schema == df.schema and sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert encrypted.read_encrypted(spark, path, key, ["id"]).agg(F.sum("id")).first()[0] == sum(range(50))
    assert not any(b"text 7" in f.read_bytes() for f in (tmp_path / "secret").iterdir())
    with pytest.raises(Exception, match="another key"):
        encrypted.read_encrypted(spark, path, b"x" * 32).collect()
    assert encrypted.write_encrypted(df.where("false"), str(tmp_path / "none"), key) == 0
    assert encrypted.read_encrypted(spark, str(tmp_path / "none"), key).count() == 0


def test_answers_are_retried_unless_refused(spark, tmp_path):
    def client():
        seen = {}

        def answer(text):
            seen[text] = seen.get(text, 0) + 1
            if text == "never":
                raise RuntimeError("down")
            if text == "refused":
                raise clients.Refused(f"after {seen[text]}")
            if text == "later" and seen[text] < 3:
                raise RuntimeError("not yet")
            return f"{text} {seen[text]}"

        return answer

    df = spark.createDataFrame([(k, t) for k, t in enumerate(["now", "later", "never", "refused", None])], "id long, text string").coalesce(1)
    ask = lambda policy: {r.id: (r.answer, r.error) for r in clients.answer_each(df, "text", client, attempts=3, first_wait=0.01, policy=policy).collect()}
    assert ask("error") == {"0": ("now 1", None), "1": ("later 3", None), "2": (None, "RuntimeError: down"), "3": (None, "Refused: after 1"), "4": (None, None)}
    assert ask("none")["2"] == (None, None)
    with pytest.raises(Exception, match="down|after"):
        ask("raise")
    with pytest.raises(ValueError):
        ask("other")


def test_groups_are_aligned_and_asked_once_more(spark):
    def client():
        calls = []

        def answer(texts):
            calls.append(len(texts))
            if "bad" in texts:
                raise RuntimeError("no JSON")
            if "short" in texts:
                return ["c"]
            return [t.upper() for t in texts] + ["surplus"]

        return answer

    df = spark.createDataFrame([(k, t) for k, t in enumerate(["a", "b", "short", "x", "bad", "y"])], "id long, text string").coalesce(1)
    found = {r.id: (r.code, r.error) for r in clients.classify_groups(df, "text", client, size=2).collect()}
    assert found == {"0": ("A", None), "1": ("B", None), "2": ("c", None), "3": (None, None), "4": (None, "RuntimeError: no JSON"), "5": (None, "RuntimeError: no JSON")}


def test_judging_resumes(spark, tmp_path):
    inputs = spark.createDataFrame([(k, f"t{k}") for k in range(40)], "id long, text string")
    path, judged = str(tmp_path / "judged"), []

    def judge(rows):
        judged.append(rows.count())
        if len(judged) == 3:
            raise RuntimeError("the service is gone")
        return rows.select("id", F.upper("text").alias("answer"))

    with pytest.raises(RuntimeError):
        clients.judge_with_checkpoint(inputs, path, judge, parts=4)
    n = sum(judged[:2])
    judged[:] = [0, 0, 0]  # the service is back
    out = clients.judge_with_checkpoint(inputs, path, judge, parts=4)
    assert sum(judged[3:]) == 40 - n and sorted((r.id, r.answer) for r in out.collect()) == sorted((k, f"T{k}") for k in range(40))


def labelled(spark):
    names = {"01.1.1": "bread loaf", "01.1.2": "bread roll", "01.2.1": "milk fresh", "02.1.1": "wine red", "02.1.2": "wine white", "98.1": "shopping trip"}
    return spark.createDataFrame([(f"{c}-{k}", f"{t} {'abcdefgh'[k % 8]}", c) for c, t in names.items() for k in range(12)], "id string, label string, code string")


def test_beams_heads_and_saved_models(spark, tmp_path):
    rows = labelled(spark)
    texts = rows.select("id", "label")
    truth = {r.id: r.code for r in rows.collect()}
    for forcing in (1.0, 0.8):
        model = classifiers.fit_cascade(rows, "label", "code", 3, forcing=forcing)
        beams = model.beams(texts, "id", 3).collect()
        best = {r.id: r.code for r in beams if r["rank"] == 1}
        assert sum(best[i] == c for i, c in truth.items()) > 0.9 * len(truth)
        assert all(sum(r.confidence for r in beams if r.id == i) <= 1 + 1e-6 for i in list(truth)[:5])
        by_row = {}
        for r in beams:
            by_row.setdefault(r.id, []).append((r["rank"], r.confidence))
        assert all([n for n, _ in sorted(x)] == list(range(1, len(x) + 1)) and [p for _, p in sorted(x)] == sorted((p for _, p in x), reverse=True) for x in by_row.values())
    heads = classifiers.fit_heads(rows, "label", "code", 3)
    found = heads.predict(texts).collect()
    assert all(r.code2.startswith(r.code1 + ".") and (r.code3 is None or r.code3.startswith(r.code2 + ".")) for r in found)
    assert sum(truth[r.id] == (r.code3 or r.code2) for r in found) > 0.9 * len(found)
    flat = classifiers.fit_flat(rows, classifiers.char_ngrams("label"), "code")
    for n, (saved, predict) in enumerate(((flat, lambda m: m.predict(texts, classifiers.char_ngrams("label"), 2)), (model, lambda m: m.predict(texts)), (heads, lambda m: m.predict(texts)))):
        path = str(tmp_path / f"model{n}")
        classifiers.save_model(saved, spark, path)
        again = classifiers.load_model(spark, path)
        assert type(again) is type(saved) and sorted(predict(again).collect()) == sorted(predict(saved).collect())


def test_fine_tuning_mixes_and_keeps_labels(spark, tmp_path):
    rows = labelled(spark)
    grams = lambda: classifiers.char_ngrams("label")
    old = classifiers.fit_flat(rows, grams(), "code")
    later = spark.createDataFrame([(f"n{k}", "oat drink", "01.2.1") for k in range(8)] + [(f"m{k}", "bread bun", "01.1.2") for k in range(8)] + [("x", "unknown", "77")], "id string, label string, code string")
    tuned = classifiers.fine_tuned(old, later, grams(), "code", weight=0.4)
    probe = spark.createDataFrame([("1", "oat drink"), ("2", "wine red a")], "id string, label string")
    whole = lambda m: {r.id: {p.code: p.confidence for p in r.predictions} for r in m.predict(probe, grams(), 10).collect()}
    before, after, new = whole(old), whole(tuned), whole(tuned.later)
    for i in ("1", "2"):
        assert set(after[i]) == set(before[i]) == set(old.labels) and set(new[i]) == {"01.2.1", "01.1.2"}
        assert all(abs(after[i][c] - (0.6 * before[i][c] + 0.4 * new[i].get(c, 0.0))) < 1e-9 for c in old.labels)
    assert max(after["1"], key=after["1"].get) == "01.2.1" and max(after["2"], key=after["2"].get) == "02.1.1"
    classifiers.save_model(tuned, spark, str(tmp_path / "tuned"))
    assert whole(classifiers.load_model(spark, str(tmp_path / "tuned"))) == after


def test_choices(spark):
    df = spark.createDataFrame([("1", "x"), ("2", None)], "id string, v string")
    assert selection.one_row(df, "id", "1") == {"id": "1", "v": "x"}
    with pytest.raises(KeyError):
        selection.one_row(df, "id", "3")
    assert selection.useful_columns(["code", "label_en", "Column1", "label_fr"]) == ["code", "label_fr"]
    names = spark.createDataFrame([("Café du Port",), ("Cafe du Port ",), ("PORT",), ("ab",), (None,)], "name string")
    pairs = {tuple(r) for r in selection.spelling_variants(names, "name").collect()}
    assert pairs == {("Cafe du Port", "Cafe du Port", "Cafe du Port"), ("Cafe du Port", "PORT", "Port"), ("PORT", "Cafe du Port", "PORT")}
