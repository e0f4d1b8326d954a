"""Command line: python -m codalith COMMAND. Queries by name, and models, evaluations and training sets over tables of one's own."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codalith.operators import classifiers, decision, metrics, networks, reports, scores, training
from codalith.plans import catalog
from codalith.sources.readers import load_training_set, read_any, write_any


def _show(rows: DataFrame, output: str | None) -> None:
    write_any(rows, output) if output else rows.show(truncate=False)


def _train(spark, a) -> None:
    rows = load_training_set(read_any(spark, a.data), technical=a.technical, code=a.code, product=a.text).where(F.col(a.code).isNotNull())
    if a.min_samples > 1:
        rows = training.supported(rows, a.code, a.min_samples)
    if a.kind == "flat":
        model = classifiers.fit_flat(rows, classifiers.char_ngrams("text"), a.code)
    elif a.kind == "embedding":
        model = networks.fit_embedding(rows, "text", a.code, a.key, a.steps, a.rate)
    elif a.kind == "embedding-cascade":
        model = networks.fit_embedding_cascade(rows, "text", a.code, a.depth, a.forcing, a.key, a.steps, a.rate)
    elif a.kind == "joint-heads":
        model = networks.fit_joint_heads(rows, "text", a.code, a.depth, a.key, steps=a.steps, rate=a.rate)
    elif a.kind == "cascade":
        model = classifiers.fit_cascade(rows, "text", a.code, a.depth, forcing=a.forcing, key=a.key)
    else:
        model = classifiers.fit_heads(rows, "text", a.code, a.depth)
    classifiers.save_model(model, spark, a.model)


def _fine_tune(spark, a) -> None:
    rows = load_training_set(read_any(spark, a.data), technical=a.technical, code=a.code, product=a.text).where(F.col(a.code).isNotNull())
    model = classifiers.load_model(spark, a.model)
    if not isinstance(model, (networks.NetworkModel, networks.EmbeddingCascade)) and not (isinstance(model, classifiers.HeadsModel) and isinstance(model.heads[0], networks.NetworkModel)):
        raise SystemExit("only models with embeddings can be fitted on")
    classifiers.save_model(networks.fine_tune(model, rows, "text", a.code, a.key, a.steps, a.rate), spark, a.tuned)


def _predict(spark, a) -> None:
    rows = read_any(spark, a.data).withColumn("text", F.lower(F.trim(a.text)))
    model = classifiers.load_model(spark, a.model)
    if isinstance(model, classifiers.FlatModel):
        out = model.predict(rows, classifiers.char_ngrams("text"), a.top_k).withColumns({"predicted": F.col("predictions")[0]["code"], "confidence": F.col("predictions")[0]["confidence"]})
    elif isinstance(model, classifiers.CascadeModel) and a.beam_size > 1:
        out = model.beams(rows, a.key, a.beam_size).where(F.col("rank") <= a.top_k)
    elif isinstance(model, classifiers.CascadeModel):
        out = model.predict(rows.drop("code", "level", "confidence"), a.threshold)
    else:
        out = model.predict(rows)
    _show(out, a.output)


def _evaluate(spark, a) -> None:
    slices = {c: F.col(c) for c in a.by.split(",") if c}
    _show(scores.slice_report(read_any(spark, a.data), a.truth, a.predicted.split(","), slices, list(range(1, a.depth + 1)), len(a.predicted.split(","))), a.output)


def _top_k(spark, a) -> None:
    ranked = a.predicted.split(",")
    _show(metrics.top_k_accuracy(read_any(spark, a.data), a.truth, ranked, list(range(1, a.depth + 1)), list(range(1, len(ranked) + 1)), [c for c in a.by.split(",") if c]), a.output)


def _training_data(spark, a) -> None:
    first, second = (read_any(spark, p).withColumn("source", F.lit(n)) for p, n in ((a.first, "first"), (a.second, "second")))
    rows = first.unionByName(second, allowMissingColumns=True)
    _show(training.balance(rows, a.code, F.col("source") == "first", a.key, a.cap), a.output)


def _decide(spark, a) -> None:
    rows = read_any(spark, a.data).withColumn(a.confidence, F.col(a.confidence).cast("double"))
    _show(rows.withColumn("decided", decision.consensus(a.first, a.confidence, a.others.split(","))), a.output)


def _serve(spark, a) -> None:
    from codalith.serving import serve

    serve(spark, a.model, a.port, a.host).serve_forever()


def _run(spark, a) -> None:
    _show(catalog.QUERIES[a.query](spark, a.tables.rstrip("/")), a.output)


def _report(spark, a) -> None:
    rows = catalog.QUERIES[a.query](spark, a.tables.rstrip("/"))
    print((reports.html_report if a.html else reports.text_report)(rows, a.query, a.keys.split(",")), end="")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="codalith")
    todo = parser.add_subparsers(dest="todo", required=True)

    def command(name: str, about: str, run, **options) -> argparse.ArgumentParser:
        p = todo.add_parser(name, help=about)
        p.set_defaults(run=run)
        for option, given in options.items():
            p.add_argument("--" + option.replace("_", "-"), **given)
        return p

    needed, output = {"required": True}, {"help": "ends with .parquet or .csv; without it the first rows are shown"}
    number = lambda n: {"type": int, "default": n}
    todo.add_parser("list", help="names of all queries")
    for name, about, run in (("run", "a query, to a table or as its first rows", _run), ("report", "a query of metrics as text or a page", _report)):
        p = command(name, about, run, tables={"required": True, "help": "folder of the Parquet tables"})
        p.add_argument("query", choices=sorted(catalog.QUERIES), metavar="QUERY")
        if name == "run":
            p.add_argument("--output", **output)
        else:
            p.add_argument("--keys", required=True, help="columns to sort by, with commas")
            p.add_argument("--html", action="store_true")
    table = {"data": needed}
    command("train", "a classifier of labels", _train, **table, model=needed, kind={"choices": ("flat", "cascade", "heads", "embedding", "embedding-cascade", "joint-heads"), "default": "cascade"}, text={"default": "product"}, code={"default": "code"}, key={"default": "id"}, depth=number(3), forcing={"type": float, "default": 1.0}, min_samples=number(1), technical={"action": "store_true"}, steps=number(50), rate={"type": float, "default": 0.05})
    command("fine-tune", "a model with embeddings on later rows of classes that it knows", _fine_tune, **table, model=needed, tuned=needed, text={"default": "product"}, code={"default": "code"}, key={"default": "id"}, technical={"action": "store_true"}, steps=number(5), rate={"type": float, "help": "a tenth of the model's own, if not given"})
    command("predict", "codes of a table's labels by a trained classifier", _predict, **table, model=needed, output=output, text={"default": "product"}, key={"default": "id"}, top_k=number(1), beam_size=number(1), threshold={"type": float, "default": 0.0})
    command("evaluate", "accuracy, F1 and top-k, overall and by level and columns", _evaluate, **table, output=output, truth={"default": "code"}, predicted={"default": "predicted", "help": "columns by rank, with commas"}, by={"default": ""}, depth=number(4))
    command("top-k", "top-k accuracy by level and columns", _top_k, **table, output=output, truth={"default": "code"}, predicted={"default": "predicted"}, by={"default": ""}, depth=number(4))
    command("training-data", "at most cap rows a code, those of the first table first", _training_data, first=needed, second=needed, output=output, code={"default": "code"}, key={"default": "id"}, cap=number(100))
    command("decide", "the first code where it is sure and no other differs", _decide, **table, output=output, first={"default": "predicted"}, confidence={"default": "confidence"}, others={"default": "lcs_code,rag_code"})
    command("serve", "a trained classifier over HTTP", _serve, model=needed, port=number(8000), host={"default": "127.0.0.1"})
    return parser


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    if args.todo == "list":
        print("\n".join(sorted(catalog.QUERIES)))
        return 0
    args.run(SparkSession.builder.appName(f"codalith {args.todo}").getOrCreate(), args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
