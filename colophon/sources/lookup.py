"""Records asked for one by one or in batches, behind clients that can be swapped."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.plans.boolean import doi_predicate, title_predicate
from colophon.sources.paged import Fetch, pages
from colophon.sources.readers import parsed_works

DOIS_PER_REQUEST = 50
ANSWERS = "asked string, status string, value string"


def _doi(x: str | None) -> str:
    return re.sub(r"^(https?://doi\.org/|doi:)", "", (x or "").strip().lower())


def _asked(rows: DataFrame, ask: Callable[[list[str]], list[tuple]], size: int) -> DataFrame:
    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        for frame in frames:
            keys = frame["key"].tolist()
            for k in range(0, len(keys), size):
                yield pd.DataFrame(ask(keys[k : k + size]), columns=["asked", "status", "value"])

    return rows.mapInPandas(run, ANSWERS)


def works_by_doi(dois: DataFrame, fetch: Fetch, size: int = DOIS_PER_REQUEST) -> DataFrame:
    """``(asked, status, value)`` for ``(key)``, a column of DOIs: ``ok`` with a record, ``not_found`` or ``failed``.

    A DOI with several records has several rows. A request that fails fails for its whole batch.
    """

    def ask(keys: list[str]) -> list[tuple]:
        try:
            records = list(pages(fetch, doi_predicate(keys)))
        except (OSError, RuntimeError) as error:
            return [(k, "failed", str(error)) for k in keys]
        by_doi: dict[str, list[dict]] = {}
        for r in records:
            by_doi.setdefault(_doi(r.get("doi")), []).append(r)
        out = [(k, "ok", json.dumps(r)) for k in keys for r in by_doi.get(_doi(k), [])]
        return out + [(k, "not_found", None) for k in keys if _doi(k) not in by_doi]

    return _asked(dois.select("key"), ask, size)


def works_by_title(titles: DataFrame, fetch: Fetch) -> DataFrame:
    """The same for ``(key)``, a column of titles: the service's first record of each."""

    def ask(keys: list[str]) -> list[tuple]:
        out = []
        for k in keys:
            try:
                found = (fetch(title_predicate(k.replace('"', ""), exact=True), "*", 1).get("results") or [])[:1]
                out.append((k, "ok", json.dumps(found[0])) if found else (k, "not_found", None))
            except (OSError, RuntimeError) as error:
                out.append((k, "failed", str(error)))
        return out

    return _asked(titles.select("key"), ask, 1)


def payloads(papers: DataFrame, get: Callable[[str], tuple[int, str]]) -> DataFrame:
    """``(paper_id, status, payload)`` for ``(paper_id, doi)``: ``get(doi)`` gives an HTTP code and a text."""

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        for frame in frames:
            rows = []
            for paper, doi in zip(frame["paper_id"], frame["doi"]):
                try:
                    code, text = get(doi)
                except OSError:
                    code, text = 0, None
                status = {200: "ok", 404: "not_found"}.get(code, "failed")
                rows.append((paper, status, text if code == 200 else None))
            yield pd.DataFrame(rows, columns=["paper_id", "status", "payload"])

    return papers.select("paper_id", "doi").mapInPandas(run, "paper_id string, status string, payload string")


def answered_works(answers: DataFrame) -> DataFrame:
    """Work records of the answers that have one."""
    lines = answers.filter("status = 'ok'").select("value", F.col("asked").alias("_file"))
    return parsed_works(lines.withColumn("_line", F.monotonically_increasing_id()))
