import pytest
from pyspark.sql import functions as F

from codalith import __main__ as cli
from codalith.operators import documents, predictions, reports
from codalith.sources import readers


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_client_answers_belong_to_keys_and_failures_stay_apart(spark):
    calls = []

    def client():
        def answer(texts):
            calls.append(len(texts))
            if "bad" in texts:
                raise RuntimeError("no service")
            return [t[::-1] for t in texts] if "short" not in texts else []

        return answer

    df = spark.createDataFrame([("1", "ab"), ("2", "bad"), ("3", "short"), ("4", None)], "id string, label string").coalesce(1)
    found = {r["id"]: (r["answer"], r["error"]) for r in predictions.map_with_client(df.where("label IS NOT NULL"), "label", client, size=1).collect()}
    assert found["1"] == ("ba", None)
    assert found["2"] == (None, "RuntimeError: no service")
    assert found["3"] == (None, "ValueError: 0 answers to 1 texts")
    assert predictions.map_with_client(df.where("id = '9'"), "label", client).count() == 0


def test_client_is_asked_again(spark, tmp_path):
    marks = str(tmp_path)

    def client():
        from pathlib import Path

        def answer(texts):
            mark = Path(marks) / texts[0]
            if not mark.exists():
                mark.touch()
                raise TimeoutError("first time")
            return texts

        return answer

    df = spark.createDataFrame([("1", "x")], "id string, label string")
    assert rows(predictions.map_with_client(df, "label", client)) == [("1", "x", None)]
    (tmp_path / "x").unlink()
    assert rows(predictions.map_with_client(df, "label", client, attempts=1)) == [("1", None, "TimeoutError: first time")]


def test_columns_by_name():
    found = predictions.ranked_columns(["predicted_level2_top2", "predicted_level1", "predicted_level2", "predicted_level2_top10", "other", "predicted_levelx"])
    assert found == {1: ["predicted_level1"], 2: ["predicted_level2", "predicted_level2_top2", "predicted_level2_top10"]}


def test_level_columns_only_where_they_lack(spark):
    df = spark.createDataFrame([("1.2.3", "kept"), (None, None)], "code string, level2 string")
    assert predictions.with_level_columns(df, "code", last=3).select("level1", "level2", "level3").collect() == [("01", "kept", "1.2.3"), (None, None, None)]


def test_wide_predictions_fill_missing_ranks(spark):
    df = spark.createDataFrame([("1", {"level1": [("01", 0.5)]}), ("2", None)], "id string, n map<string, array<struct<code: string, confidence: double>>>")
    wide = predictions.wide_predictions(df, "n", [1, 2], 2)
    assert rows(wide.select("id", "predicted_level1", "confidence_level1", "predicted_level1_top2", "predicted_level2")) == [("1", "01", 0.5, "", ""), ("2", "", 0.0, "", "")]


def test_labels_default_to_code_or_nothing(spark):
    df = spark.createDataFrame([("01",), ("02",), (None,)], "code string")
    names = spark.createDataFrame([("01", "food"), ("01", "food")], "code string, label string")
    assert rows(predictions.with_label(df, names, "code", "name").select("code", "name")) == [("01", "food"), ("02", "02"), (None, None)]
    assert rows(predictions.with_label(df, names, "code", "name", False).select("name")) == [("",), ("",), ("food",)]


def test_text_report(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", None)], "k string, accuracy double")
    assert reports.text_report(df, "Title", ["k"]).splitlines() == ["Title", "=====", "k  accuracy", "-  --------", "a", "b  0.5000"]


def test_filters_are_optional(spark):
    df = spark.createDataFrame([("98.1", "98.1", "Bio", 0.1)], "code string, predicted string, label string, confidence double")
    assert reports.where_all(df).count() == 1
    assert reports.where_all(df, technical=True, contains="BIO", prefix="98").count() == 1
    assert reports.where_all(df, technical=False).count() == 0
    assert reports.where_all(df, min_confidence=0.2).count() == 0


def test_nothing_to_report(spark):
    df = spark.createDataFrame([], "code string, predicted string, confidence double, shop string")
    assert reports.scores_by_threshold(df, "code", "predicted", "confidence", [1], [0.0]).count() == 0
    assert reports.heat_map(df, "code", "predicted", "shop", [1]).count() == 0
    assert {r["n"] for r in reports.severity_counts(df, "code", "predicted", "confidence").collect()} == {0}


def test_deep_codes_match_by_the_beginning_of_their_second_level(spark):
    notices = spark.createDataFrame([(c, c) for c in ("01", "01.1", "01.11", "01.1.1", "01.11.2", "01.2.1", "02", "02.1.1")], "code string, label string")
    seen = spark.createDataFrame([("a", "01.1.9"), ("b", None), ("c", "02"), ("d", "77")], "id string, p string")
    found = {r["id"]: r["codes"] for r in documents.relevant_codes(seen, notices, ["p"]).collect()}
    assert found["a"] == ["01", "01.1", "01.1.1", "01.11", "01.11.2"]  # 01.11.2 begins with 01.1
    assert len(found["b"]) == 8
    assert found["c"] == ["02"] and found["d"] == []


def test_periods_are_a_set_when_several(spark, tmp_path):
    base = str(tmp_path / "t.parquet")
    df = spark.createDataFrame([(1, 2024, 1), (1, 2024, 1), (2, 2024, 2), (3, 2025, 1)], "x long, annee int, mois int")
    df.write.partitionBy("annee", "mois").parquet(base)
    assert sorted(r["x"] for r in readers.read_periods(spark, base, [2024], [1]).collect()) == [1, 1]
    several = readers.read_periods(spark, base, [2024], [1, 2])
    assert sorted(r["x"] for r in several.collect()) == [1, 2]
    assert "PartitionFilters: [" in several._jdf.queryExecution().explainString(several._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_annotated_folder_reports_bad_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("product;code;amount\nbread;01.1;2,5\n")
    (tmp_path / "b.csv").write_text("x;y\n1;2\n")
    df, bad = readers.read_annotated_folder(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert rows(df.select("product", "code", "amount")) == [("bread", "01.1", 2.5)]
    assert list(bad) == [str(tmp_path / "b.csv")]
    assert readers.read_annotated_folder(spark, [])[0] is None


def test_positions_and_nomenclature_layouts(spark, tmp_path):
    (tmp_path / "p.csv").write_text("h1;h2;h3\na;01;z\n")
    assert rows(readers.read_by_position(spark, str(tmp_path / "p.csv"), ["product", "code"])) == [("a", "01")]
    (tmp_path / "n.csv").write_text("Code;Libelle\n01;Food\n98.1;Other\n")
    assert rows(readers.read_nomenclature(spark, str(tmp_path / "n.csv"), technical=False)) == [("01", "Food", None, None)]
    with pytest.raises(ValueError):
        readers.read_nomenclature(spark, str(tmp_path / "p.csv"))


def test_notice_sections(spark):
    body = "Bread and  cereals\nComprend :\nrice\nflour\nNe comprend pas :\npies"
    df = spark.createDataFrame([(body,), (None,)], "body string").select(readers.notice_sections("body").alias("s")).select("s.*")
    assert df.collect() == [("Bread and cereals", "rice\nflour", "pies"), ("", "", "")]


def test_written_tables(spark, tmp_path):
    df = spark.createDataFrame([("a", [1.0]), ("b", []), (None, [2.0])], "code string, embedding array<double>")
    readers.write_tables({"one": df, "two": df.select(F.col("code"))}, str(tmp_path))
    readers.write_vectors(df, str(tmp_path / "v"))
    assert spark.read.parquet(str(tmp_path / "two")).count() == 3
    assert rows(spark.read.parquet(str(tmp_path / "v")).select("code")) == [("a",)]


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    assert cli.main(["list"]) == 0 and "top_confusions" in capsys.readouterr().out
    data = "/root/testdata/sf0.001"
    assert cli.main(["report", "key_figures", "--tables", data, "--keys", "n"]) == 0
    assert capsys.readouterr().out.startswith("key_figures\n===")
    assert cli.main(["run", "hash_split", "--tables", data, "--output", str(tmp_path / "o.parquet")]) == 0
    assert spark.read.parquet(str(tmp_path / "o.parquet")).count() == 1500
    with pytest.raises(SystemExit):
        cli.main(["run", "no_such_query", "--tables", data])
