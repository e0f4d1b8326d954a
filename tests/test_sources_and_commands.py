import json
import threading
import urllib.error
import urllib.request

import pytest
from pyspark.sql import functions as F

from codalith import serving
from codalith.__main__ import main
from codalith.operators import ingest, reports
from codalith.sources import readers


def test_annotated_layouts(spark, tmp_path):
    (tmp_path / "a.csv").write_text("product;code1;price;store_type\npain;01.1;1,50;x\n;01.2;2;x\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text('Nature de la dépense,coicop,Montant,Enseigne ou type de magasin\nlait,01.2,"2,25",y\neau,,1,y\n', encoding="utf-8")
    (tmp_path / "c.csv").write_text("product;Code coicop;Montant de la dépense;Nomen_mag\nvin;02.1;7;Hypermarchés\nriz;01.1;;Marché\n", encoding="utf-8")
    out, bad = readers.read_annotated_folder(spark, [str(tmp_path / f"{n}.csv") for n in "abc"])
    assert not bad
    assert sorted((r.product, r.code, r.amount, r.is_hypermarche) for r in out.collect()) == [("lait", "01.2", 2.25, None), ("pain", "01.1", 1.5, None), ("riz", "01.1", None, False), ("vin", "02.1", 7.0, True)]
    (tmp_path / "d.csv").write_text("x;y\n1;2\n")
    with pytest.raises(ValueError):
        readers.read_annotated(spark, str(tmp_path / "d.csv"))


def test_vectors_are_replaced_by_key(spark, tmp_path):
    path = str(tmp_path / "vectors")
    table = lambda rows: spark.createDataFrame(rows, "code string, text string, embedding array<float>")
    with pytest.raises(FileNotFoundError):
        readers.latest_vectors(spark, path)
    assert readers.upsert_vectors(table([("a", "1", [1.0]), ("b", "1", [2.0]), (None, "1", [1.0]), ("c", "1", [])]), path) == 2
    assert readers.upsert_vectors(table([("b", "2", [4.0]), ("b", "3", [3.0]), ("d", "2", [5.0])]), path) == 3
    version, rows = readers.latest_vectors(spark, path)
    assert version == 2 and sorted((r.code, r.text) for r in rows.collect()) == [("a", "1"), ("b", "3"), ("d", "2")]


def test_training_set_with_cleaning(spark):
    df = spark.createDataFrame([("Le Pain  BIO", "1.1.2"), ("rien", "01.1"), ("taxe", "98.1"), ("œufs", None)], "product string, code string")
    rows = {r.product_orig: r for r in readers.load_training_set(df, ["le"]).collect()}
    assert set(rows) == {"Le Pain  BIO", "œufs"} and rows["Le Pain  BIO"].text == "pain bio" and rows["Le Pain  BIO"].level1 == "01" and rows["œufs"].text == "oeufs"
    assert readers.load_training_set(df, technical=True).count() == 4


def test_duplicates_and_first_rows(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, None, "x"), (4, None, "x"), (5, "b", "x")], "id long, p string, c string")
    assert {r.id: r.is_duplicate for r in ingest.flag_duplicates(df, ["p", "c"]).collect()} == {1: True, 2: True, 3: True, 4: True, 5: False}
    assert sorted(r.id for r in ingest.keep_first(df.orderBy(F.desc("id")), ["p", "c"], ["id"]).collect()) == [1, 3, 5]


def test_html_report(spark):
    page = reports.html_report(spark.createDataFrame([("<b>", 0.5), (None, 1.0)], "name string, share double"), "A & B", ["share"])
    assert "<td>&lt;b&gt;</td><td>0.5000</td>" in page and "<h1>A &amp; B</h1>" in page


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("commands")
    names = {"01.1.1": "bread loaf", "01.2.1": "milk fresh", "02.1.1": "wine red", "98.1": "shopping trip"}
    rows = [(f"{c}-{k}", f"{t} {'abcdefgh'[k % 8]}", c) for c, t in names.items() for k in range(12)]
    spark.createDataFrame(rows, "id string, product string, code string").write.parquet(f"{folder}/rows.parquet")
    return folder


@pytest.mark.parametrize("kind", ["flat", "cascade", "heads"])
def test_train_predict_evaluate(spark, files, kind):
    data, model, out = f"{files}/rows.parquet", f"{files}/{kind}", f"{files}/{kind}-out.parquet"
    assert main(["train", "--data", data, "--model", model, "--kind", kind, "--min-samples", "2"]) == 0
    if kind == "cascade":
        assert main(["predict", "--data", data, "--model", model, "--beam-size", "3", "--top-k", "2", "--output", out]) == 0
        rows = spark.read.parquet(out)
        assert rows.where("rank = 1").count() == 48 and rows.where("rank > 2").count() == 0
        return
    assert main(["predict", "--data", data, "--model", model, "--output", out]) == 0
    rows = spark.read.parquet(out)
    column = "predicted" if kind == "flat" else "code3"
    right = rows.where(f"{column} = code").count()
    assert right == 36 and rows.count() == 48  # the technical code isn't taught
    scored = f"{files}/{kind}-scored.parquet"
    assert main(["evaluate", "--data", out, "--predicted", column, "--output", scored]) == 0
    overall = spark.read.parquet(scored).where("slice = 'overall'").first()
    assert overall.n == 48 and abs(overall.accuracy - 0.75) < 1e-9


def test_other_commands(spark, files, capsys):
    data = f"{files}/rows.parquet"
    out = f"{files}/data.parquet"
    assert main(["training-data", "--first", data, "--second", data, "--cap", "5", "--output", out]) == 0
    assert {r.n for r in spark.read.parquet(out).groupBy("code").agg(F.count("*").alias("n")).collect()} == {5}
    spark.createDataFrame([("1", "01", "0.95", "01", None), ("2", "01", "0.95", "02", "01"), ("3", "01", "0.5", "01", "01")], "id string, predicted string, confidence string, lcs_code string, rag_code string").write.parquet(f"{files}/decide.parquet")
    assert main(["decide", "--data", f"{files}/decide.parquet", "--output", f"{files}/decided.parquet"]) == 0
    assert {r.id: r.decided for r in spark.read.parquet(f"{files}/decided.parquet").collect()} == {"1": "01", "2": None, "3": None}
    assert main(["top-k", "--data", data, "--predicted", "code", "--depth", "2"]) == 0
    assert "accuracy" in capsys.readouterr().out


def test_service(spark, files):
    model = f"{files}/served"
    assert main(["train", "--data", f"{files}/rows.parquet", "--model", model, "--kind", "flat"]) == 0
    server = serving.serve(spark, model, port=0)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_address[1]}"

    def ask(path, body=None):
        request = urllib.request.Request(base + path, None if body is None else json.dumps(body).encode() if not isinstance(body, bytes) else body)
        try:
            with urllib.request.urlopen(request, timeout=60) as r:
                return r.status, json.loads(r.read())
        except urllib.error.HTTPError as e:
            return e.code, json.loads(e.read())

    try:
        assert ask("/health") == (200, {"status": "ok", "model_loaded": True, "model_path": model})
        assert ask("/model/info")[1]["class_counts"] == {"level1": 3}
        status, out = ask("/predict", {"text": "red wine", "top_k": 2})
        assert status == 200 and [p["code"] for p in out["prediction"]["predictions"]][0] == "02.1.1" and len(out["prediction"]["predictions"]) == 2
        assert ask("/predict/batch", {"texts": ["milk", "bread"]})[1]["count"] == 2
        assert ask("/predict/batch", {"texts": ["x"] * 1025})[0] == 422 and ask("/predict", {})[0] == 422 and ask("/predict", b"{")[0] == 422 and ask("/other")[0] == 404
    finally:
        server.shutdown()
        server.server_close()
