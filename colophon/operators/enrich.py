"""Affiliations from other services' payloads, set on the rows they belong to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.functions.normalize import arxiv_pdf_url, blank_to_null, not_blank, strip_space
from colophon.operators.ingest import fill_nulls
from colophon.operators.matching import align_authors, align_positions

CROSSREF = "struct<message: struct<author: array<struct<ORCID: string, given: string, family: string, affiliation: array<struct<name: string>>>>>>"
SCHOLAR = "struct<authors: array<struct<name: string, affiliations: array<string>>>>"
PDF_SOURCES = ("unpaywall", "catalog", "arxiv")


def orcid_key(x: Column) -> Column:
    return blank_to_null(F.regexp_replace(strip_space(x), r"(?i)^https?://orcid\.org/", ""))


def crossref_authors(payloads: DataFrame) -> DataFrame:
    """``(paper_id, pos, orcid, affiliations)`` from ``(paper_id, payload)``."""
    rows = payloads.select("paper_id", F.posexplode(F.from_json("payload", CROSSREF)["message"]["author"]).alias("pos", "a"))
    names = F.filter(F.transform(F.coalesce("a.affiliation", F.array()), lambda x: F.trim(x["name"])), lambda n: n != "")
    return rows.select("paper_id", "pos", orcid_key(F.col("a.ORCID")).alias("orcid"), names.alias("affiliations"))


def scholar_authors(payloads: DataFrame) -> DataFrame:
    rows = payloads.select("paper_id", F.posexplode(F.from_json("payload", SCHOLAR)["authors"]).alias("pos", "a"))
    names = F.filter(F.coalesce("a.affiliations", F.array()), lambda n: not_blank(n))
    return rows.select("paper_id", "pos", names.alias("affiliations"))


def _gaps(contributions: DataFrame) -> DataFrame:
    return contributions.filter(F.col("institution_id").isNull() & ~not_blank(F.col("raw_affiliation_string")))


def _restored(contributions: DataFrame, aligned: DataFrame, authors: DataFrame) -> DataFrame:
    found = aligned.join(authors.withColumnRenamed("pos", "other_pos"), ["paper_id", "other_pos"]).filter(F.size("affiliations") > 0)
    found = found.select("row_id", F.array_join("affiliations", " | ").alias("raw_affiliation_string"))
    raw = F.when(not_blank(F.col("raw_affiliation_string")), F.col("raw_affiliation_string"))
    return fill_nulls(contributions.withColumn("raw_affiliation_string", raw), found, "row_id", ["raw_affiliation_string"])


def from_crossref(contributions: DataFrame, authors: DataFrame, payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Contributions with restored affiliations, and the alignment."""
    known = authors.select(F.col("id").alias("author_id"), orcid_key(F.col("orcid")).alias("orcid"))
    targets = _gaps(contributions).join(known, "author_id", "left").select("paper_id", "row_id", "orcid")
    others = crossref_authors(payloads)
    targets = targets.join(others.select("paper_id").distinct(), "paper_id", "left_semi")
    aligned = align_authors(targets, others)
    return _restored(contributions, aligned.filter("other_pos is not null"), others), aligned


def from_scholar(contributions: DataFrame, payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    others = scholar_authors(payloads)
    targets = _gaps(contributions).select("paper_id", "row_id")
    aligned = align_positions(targets, others)
    return _restored(contributions, aligned, others), aligned


def pdf_url(sources: tuple[str, ...] = PDF_SOURCES) -> Column:
    """First URL, in the order of sources, over columns doi, unpaywall and catalog (payload structs)."""
    if not sources or not set(sources) <= set(PDF_SOURCES):
        raise ValueError(f"sources are {', '.join(PDF_SOURCES)}")

    def first(rows: str, field: str) -> Column:
        return F.get(F.filter(F.transform(rows, lambda x: x[field]), lambda u: u.isNotNull()), F.lit(0))

    of = {
        "unpaywall": F.coalesce("unpaywall.best_oa_location.url_for_pdf", first("unpaywall.oa_locations", "url_for_pdf")),
        "catalog": F.coalesce(
            "catalog.best_oa_location.pdf_url", "catalog.primary_location.pdf_url", first("catalog.locations", "pdf_url")
        ),
        "arxiv": arxiv_pdf_url(F.col("doi")),
    }
    return F.coalesce(*[of[s] for s in sources])
