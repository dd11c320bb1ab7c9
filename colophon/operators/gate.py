"""Checks that stop a run: queries, topics, and papers that a search must find."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.functions.normalize import anchor_entry, doi_checked, title_loose
from colophon.operators.matching import anchor_coverage
from colophon.plans import boolean


class Rejected(Exception):
    """Why a run must not go on."""


def checked_query(text: str) -> str:
    """The query in one line, or ``Rejected`` with its faults."""
    query = boolean.normalize(text)
    if faults := boolean.lint(query):
        raise Rejected("; ".join(faults))
    return query


def split_topics(topics: list[str]) -> tuple[list[str], list[str]]:
    """Well-formed topic ids and the others."""
    good = [t for t in topics if re.fullmatch(boolean.TOPIC_FORM, t)]
    return good, [t for t in topics if t not in set(good)]


def entries(works: DataFrame, raw: list[str]) -> DataFrame:
    """The anchors as rows ``raw, kind, normalized``; titles without a letter or digit are invalid."""
    spark = works.sparkSession
    rows = spark.createDataFrame([(x.strip(),) for x in raw if x.strip()], "raw string").select(anchor_entry(F.col("raw")).alias("e")).select("e.*")
    blank = (F.col("kind") == "title") & (F.coalesce("normalized", F.lit("")) == "")
    return rows.withColumn("kind", F.when(blank, "invalid").otherwise(F.col("kind")))


def anchor_report(works: DataFrame, raw: list[str], doi: str = "doi", title: str = "title") -> DataFrame:
    """``(raw, kind, normalized, found)`` of the anchors among the works of a search."""
    keys = works.select(doi_checked(F.col(doi)).alias("doi"), title_loose(F.col(title)).alias("title"))
    return anchor_coverage(entries(works, raw), keys)


def enforce_anchors(works: DataFrame, raw: list[str]) -> DataFrame:
    """The report, or ``Rejected`` if there is no anchor, an invalid one, or one that the search lacks."""
    if not [x for x in raw if x.strip()]:
        raise Rejected("no anchors")
    found = anchor_report(works, raw)
    rows = found.collect()  # a list made by hand
    invalid = [r["raw"] for r in rows if r["kind"] == "invalid"]
    missing = [r["raw"] for r in rows if r["kind"] != "invalid" and not r["found"]]
    if invalid or missing:
        raise Rejected("; ".join([f"invalid: {x}" for x in invalid] + [f"missing: {x}" for x in missing]))
    return found
