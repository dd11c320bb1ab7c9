"""Structured answers of a language model: what it is asked, and what is made of its answers."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: ``complete(prompt, most_tokens)`` gives the model's text.
Complete = Callable[[str, int], str]
MOST_TOKENS = {"1": 1200, "2": 400, "3": 300, "pdf": 1500}
_TASKS = {
    "1": "For each affiliation name the main institution (no departments or addresses) and its two-letter country code.",
    "2": "For each institution give its two-letter country code, from display_name and sample_affiliation.",
    "3": "For each affiliation give the two-letter country code.",
    "pdf": "List the authors on this first page in order, each with the main institution and its two-letter country code.",
}
_SHAPES = {
    "1": '{"predictions": [{"row_id": ..., "institution_name": ..., "country_code": ..., "confidence": 0 to 1}]}',
    "2": '{"predictions": [{"row_id": ..., "country_code": ..., "status": "unambiguous, ambiguous or none", "confidence": 0 to 1}]}',
    "pdf": '{"authors": [{"position": 0, "given": ..., "family": ..., "orcid": ..., "institution": ..., "country_code": ..., "confidence": 0 to 1}]}',
}
_SHAPES["3"] = _SHAPES["2"]


def prompt_for(stage: str, asked: list[dict] | str) -> str:
    given = asked if isinstance(asked, str) else json.dumps(asked, ensure_ascii=False)
    return f"{_TASKS[stage]} Use null where unsure and keep each row_id. Answer with JSON alone, like {_SHAPES[stage]}\n{given}"


def answer_items(answer: str, stage: str) -> list[dict]:
    """The items of an answer that have their ``row_id`` (``position`` on pages); none if it is no JSON.

    Codes are upper case, a missing status is ``none`` and a missing confidence 0; blank texts are null.
    """
    key, must = ("authors", "position") if stage == "pdf" else ("predictions", "row_id")
    body = re.search(r"[\[{].*[\]}]", re.sub(r"(?s)<think>.*?</think>", "", answer or ""), re.S)
    try:
        made = json.loads(body[0]) if body else []
    except ValueError:
        return []
    items = made.get(key) if isinstance(made, dict) else made
    out = []
    for item in items if isinstance(items, list) else []:
        if not isinstance(item, dict) or item.get(must) is None:
            continue
        item = {k: (v.strip() or None) if isinstance(v, str) else v for k, v in item.items()}
        if item.get("country_code"):
            item["country_code"] = str(item["country_code"]).upper()
        if isinstance(item[must], str) and re.fullmatch(r"-?\d+", item[must]):
            item[must] = int(item[must])
        item["status"] = str(item.get("status") or "none").lower()
        item["confidence"] = float(item.get("confidence") or 0)
        out.append(item)
    return out


def predictor(complete: Complete, stage: str) -> Callable[[list[dict]], list[dict]]:
    """What ``impute.predict`` needs for a stage."""
    return lambda rows: answer_items(complete(prompt_for(stage, rows), MOST_TOKENS[stage]), stage)


def page_predictor(complete: Complete) -> Callable[[str], list[dict]]:
    return lambda text: answer_items(complete(prompt_for("pdf", text), MOST_TOKENS["pdf"]), "pdf")


def service_key(text: str) -> str | None:
    """The first key of a pasted text."""
    found = re.search(r"gsk_[A-Za-z0-9]+", text or "")
    return found[0] if found else None


VECTORS = "fingerprint string, vector array<float>"


def cached_vectors(records: DataFrame, embed: Callable[[list[str]], list[list[float]]], path: str) -> DataFrame:
    """``(id, vector)`` for ``(id, display_name, country_code)``; only what the cache at ``path`` lacks is embedded.

    A record's fingerprint is the SHA-1 of its three values, so a changed record is embedded anew.
    """
    spark = records.sparkSession
    line = F.concat_ws("\t", F.col("id").cast("string"), "display_name", F.coalesce("country_code", F.lit("")))
    marked = records.select("id", "display_name", F.sha1(line).alias("fingerprint"))
    try:
        have = spark.read.schema(VECTORS).parquet(path)
        have.limit(1).count()
    except Exception as error:  # no cache yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
        have = spark.createDataFrame([], VECTORS)

    def run(frames: Iterator) -> Iterator:
        for frame in frames:
            made = embed(frame["display_name"].tolist()) if len(frame) else []
            yield pd.DataFrame({"fingerprint": frame["fingerprint"], "vector": [list(map(float, v)) for v in made]}, columns=["fingerprint", "vector"])

    new = marked.dropDuplicates(["fingerprint"]).join(have, "fingerprint", "left_anti")
    new.select("fingerprint", "display_name").mapInPandas(run, VECTORS).write.mode("append").parquet(path)
    every = spark.read.schema(VECTORS).parquet(path).dropDuplicates(["fingerprint"])
    return marked.join(every, "fingerprint").select("id", "vector")


def embedded(rows: DataFrame, column: str, embed: Callable[[list[str]], list[list[float]]]) -> DataFrame:
    """``rows`` with ``vector``, of the texts in ``column``."""
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([list(map(float, v)) for v in embed(texts.tolist())])

    return rows.withColumn("vector", F.pandas_udf(run, "array<float>")(column))
