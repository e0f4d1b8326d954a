"""A small HTTP service over a saved model: /health, /predict, /predict/batch, /model/info. JSON in and out.

Meant for one driver and short lists of texts; tables go through a model's predict.
"""

from __future__ import annotations

import json
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from codalith.operators import classifiers

LARGEST_BATCH = 1024


class BadRequest(ValueError):
    """What the caller can mend."""


class Service:
    """Answers to paths, without the network."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.model = classifiers.load_model(spark, path)

    def _predict(self, texts: list[str], top_k: int) -> list[dict]:
        if not isinstance(texts, list) or not texts or not all(isinstance(t, str) for t in texts):
            raise BadRequest("texts is a list of one text or more")
        if len(texts) > LARGEST_BATCH:
            raise BadRequest(f"at most {LARGEST_BATCH} texts at once")
        column = getattr(self.model, "text", None) or "text"
        df = self.spark.createDataFrame([(n, t) for n, t in enumerate(texts)], f"n int, `{column}` string")
        if isinstance(self.model, classifiers.FlatModel):
            rows = self.model.predict(df, classifiers.char_ngrams(column), top_k).select("n", F.to_json(F.struct("predictions")).alias("j"))
        elif isinstance(self.model, classifiers.CascadeModel) and top_k > 1:
            rows = self.model.beams(df, "n", top_k).groupBy("n").agg(F.to_json(F.struct(F.array_sort(F.collect_list(F.struct("rank", "code", "confidence"))).alias("predictions"))).alias("j"))
        else:
            rows = self.model.predict(df).drop(column)
            rows = rows.select("n", F.to_json(F.struct(*[c for c in rows.columns if c != "n"])).alias("j"))
        found = {r["n"]: json.loads(r["j"]) for r in rows.collect()}
        return [found[n] for n in range(len(texts))]

    def answer(self, method: str, path: str, body: dict | None = None) -> dict:
        if (method, path) == ("GET", "/health"):
            return {"status": "ok", "model_loaded": True, "model_path": self.path}
        if (method, path) == ("GET", "/model/info"):
            parts = [self.model] if isinstance(self.model, classifiers.FlatModel) else self.model.levels if isinstance(self.model, classifiers.CascadeModel) else self.model.heads
            return {"model_path": self.path, "kind": type(self.model).__name__, "class_counts": {f"level{n}": len(p.labels) for n, p in enumerate(parts, 1)}}
        if method == "POST" and path in ("/predict", "/predict/batch"):
            body = body or {}
            top_k = body.get("top_k", 1)
            if not isinstance(top_k, int) or not 1 <= top_k <= 100:
                raise BadRequest("top_k is a whole number from 1 to 100")
            if path == "/predict":
                return {"prediction": self._predict([body.get("text")], top_k)[0]}
            found = self._predict(body.get("texts"), top_k)
            return {"predictions": found, "count": len(found)}
        raise KeyError(path)


def handler(service: Service) -> type[BaseHTTPRequestHandler]:
    class Handler(BaseHTTPRequestHandler):
        def _respond(self, method: str) -> None:
            try:
                raw = self.rfile.read(int(self.headers.get("Content-Length") or 0))
                body = json.loads(raw) if raw else None
                if body is not None and not isinstance(body, dict):
                    raise BadRequest("the body is an object")
                code, out = 200, service.answer(method, self.path, body)
            except KeyError:
                code, out = 404, {"error": "not found"}
            except ValueError as e:  # broken JSON too
                code, out = 422, {"error": str(e)}
            data = json.dumps(out).encode()
            self.send_response(code)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def do_GET(self) -> None:
            self._respond("GET")

        def do_POST(self) -> None:
            self._respond("POST")

        def log_message(self, format, *args) -> None:
            pass

    return Handler


def serve(spark: SparkSession, path: str, port: int = 8000, host: str = "127.0.0.1") -> ThreadingHTTPServer:
    """A server that is bound and not yet running; call its serve_forever."""
    return ThreadingHTTPServer((host, port), handler(Service(spark, path)))
