"""Word lists, rules and run settings from files, and settings for object stores."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession


def _text(spark: SparkSession, path: str) -> str:
    """A small file, from wherever Spark can read."""
    return spark.read.text(path, wholetext=True).first()[0]


def read_words(spark: SparkSession, path: str) -> list[str]:
    """A JSON list of words, as stop-word files are; each word once, in order."""
    words = json.loads(_text(spark, path))
    if not isinstance(words, list) or not all(isinstance(w, str) for w in words):
        raise ValueError(f"{path} is no list of words")
    return list(dict.fromkeys(words))


def read_settings(spark: SparkSession, path: str) -> Any:
    """JSON, or YAML where its library is there."""
    text = _text(spark, path)
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("YAML files need the library yaml") from e
    return yaml.safe_load(text)


def read_rules(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(pattern, code) in order, of a list of mappings under a key rules or at the top."""
    found = read_settings(spark, path)
    items = found["rules"] if isinstance(found, dict) else found
    return [(x["pattern"], str(x["code"])) for x in items]


def overridden(settings: dict, arguments: dict[str, Any], places: dict[str, str]) -> dict:
    """settings with the arguments that aren't None, each put at its dotted place; settings themselves stay."""
    out = json.loads(json.dumps(settings))
    for name, place in places.items():
        if arguments.get(name) is None:
            continue
        *above, last = place.split(".")
        at = out
        for key in above:
            at = at.setdefault(key, {})
        at[last] = arguments[name]
    return out


def object_store_options(key: str, secret: str, endpoint: str | None = None, token: str | None = None, path_style: bool = True) -> dict[str, str]:
    """Options of an S3 file system for a session's builder; the values come from the caller, never from here."""
    out = {"spark.hadoop.fs.s3a.access.key": key, "spark.hadoop.fs.s3a.secret.key": secret, "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower()}
    if endpoint:
        out["spark.hadoop.fs.s3a.endpoint"] = endpoint
    if token:
        out |= {"spark.hadoop.fs.s3a.session.token": token, "spark.hadoop.fs.s3a.aws.credentials.provider": "org.apache.hadoop.fs.s3a.TemporaryAWSCredentialsProvider"}
    return out
