"""All ways to fill gaps, in their fixed order."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.functions.normalize import doi_key
from colophon.operators import enrich, extract, impute, imports, pdf
from colophon.operators.runstats import RunStats
from colophon.schemas import empty_table
from colophon.sources.lookup import payloads
from colophon.storage import fixed

Tables = dict[str, DataFrame]
ANSWERS = {
    "1": "row_id long, institution_name string, country_code string, confidence double",
    "2": "row_id string, country_code string, status string, confidence double",
    "3": "row_id long, country_code string, status string, confidence double",
}


@dataclass(frozen=True)
class Services:
    """What may be asked; a step without its service is left out.

    ``predict`` has a predictor for each of the stages ``1``, ``2``, ``3`` and ``pdf``.
    """

    catalog: Callable | None = None
    crossref: Callable | None = None
    scholar: Callable | None = None
    predict: dict[str, Callable] | None = None
    pdf_urls: DataFrame | None = None
    pdf_get: Callable | None = None
    pdf_cache: str = ""


@dataclass(frozen=True)
class Asking:
    """Which predictions count, how many rows a request has, and how names find known institutions.

    With ``embed`` predicted names are matched by their vectors at ``threshold``; ``cache`` names a folder that keeps
    the vectors of institutions from run to run.
    """

    least: float = 0.8
    batch: int = 20
    threshold: float = 0.78
    embed: Callable | None = None
    cache: str = ""


def name_vectors(institutions: DataFrame, said: DataFrame, asking: Asking) -> DataFrame | None:
    """``(id, vector, kind)`` of known institutions and of the names that predictions give."""
    if not asking.embed:
        return None
    known = institutions.select("id", F.coalesce("display_name", F.lit("")).alias("display_name"), "country_code").filter("display_name <> ''")
    if asking.cache:
        known = extract.cached_vectors(known, asking.embed, asking.cache)
    else:
        known = extract.embedded(known.select("id", "display_name"), "display_name", asking.embed).select("id", "vector")
    # one vector for each name, however many rows have it
    asked = impute.clean_predictions(said, least=asking.least).filter("institution_name is not null").select(F.col("row_id").cast("string").alias("id"), "institution_name")
    made = extract.embedded(asked.select("institution_name").distinct(), "institution_name", asking.embed)
    asked = asked.join(made, "institution_name").select("id", "vector", F.lit("prediction").alias("kind"))
    return fixed(known.withColumn("kind", F.lit("institution")).unionByName(asked))


def restored(tables: Tables, get: Callable, by_name: bool, limit: int | None = None) -> Tables:
    """Affiliations from a service's payloads, with authors' ids (``by_name``: places alone)."""
    gaps = impute.papers_lacking(tables["papers"], tables["contributions"], raw_too=True).select(F.col("id").alias("paper_id"), "doi")
    gaps = gaps.filter("doi is not null").orderBy("paper_id").limit(limit) if limit else gaps.filter("doi is not null")
    said = fixed(payloads(gaps, get)).filter("status = 'ok'").select("paper_id", "payload")
    if by_name:
        out, _ = enrich.from_scholar(tables["contributions"], said)
    else:
        out, _ = enrich.from_crossref(tables["contributions"], tables["authors"], said)
    return tables | {"contributions": fixed(out)}


def by_stages(
    tables: Tables, stages: list[int], predict: dict[str, Callable], limit: int | None = None, asking: Asking = Asking(), stats: RunStats | None = None
) -> tuple[Tables, DataFrame]:
    """Stages 1 to 3, by rule first where there is one, then by prediction: the tables and their audit."""
    tables, log = dict(tables), empty_table(tables["papers"].sparkSession, "country_imputation_audit")
    contributions, institutions = tables["contributions"], tables["institutions"]
    if 1 in stages and "1" in predict:
        asked = impute.missing_institution(contributions, limit).select("row_id", "raw_affiliation_string")
        said = fixed(impute.predict(asked, predict["1"], ANSWERS["1"], asking.batch))
        names = name_vectors(institutions, said, asking)
        contributions, institutions, made = impute.stage_1(contributions, institutions, said, names, asking.threshold, asking.least, stats)
        contributions, institutions, log = fixed(contributions), fixed(institutions), log.unionByName(made)
    if 2 in stages:
        said = None
        if "2" in predict:
            asked = impute.institutions_missing_country(institutions, contributions).withColumnRenamed("id", "row_id")
            said = fixed(impute.predict(asked, predict["2"], ANSWERS["2"], asking.batch)).withColumnRenamed("row_id", "id")
        contributions, institutions, made = impute.stage_2(contributions, institutions, said, asking.least, stats)
        contributions, institutions, log = fixed(contributions), fixed(institutions), log.unionByName(made)
    if 3 in stages:
        said = None
        if "3" in predict:
            asked = impute.missing_country(contributions, limit).select("row_id", "raw_affiliation_string")
            said = fixed(impute.predict(asked, predict["3"], ANSWERS["3"], asking.batch))
        contributions, made = impute.stage_3(contributions, said, asking.least, stats)
        contributions, log = fixed(contributions), log.unionByName(made)
    return impute.hong_kong_repair(tables | {"contributions": contributions, "institutions": institutions}), fixed(log)


def impute_all(
    tables: Tables, services: Services, stages: list[int] = impute.STAGES, limit: int | None = None, asking: Asking = Asking(), stats: RunStats | None = None
) -> tuple[Tables, DataFrame]:
    """Catalog, affiliations by ORCID, affiliations by place, stages, first pages: the tables and the audit."""
    tables = imports.evolved(tables)
    if services.catalog:
        tables, _ = imports.ask_again(tables, services.catalog, limit)
    if services.crossref:
        tables = restored(tables, services.crossref, False, limit)
    if services.scholar:
        tables = restored(tables, services.scholar, True, limit)
    predict = services.predict or {}
    tables, log = by_stages(tables, list(stages), predict, limit, asking, stats)
    if services.pdf_get and services.pdf_urls is not None and "pdf" in predict:
        tables, made = by_pages(tables, services, limit)
        log = log.unionByName(made)
    return tables, log


def by_pages(tables: Tables, services: Services, limit: int | None = None) -> tuple[Tables, DataFrame]:
    """The first pages' part alone; ``pdf_urls`` has doi and url."""
    gaps = impute.papers_lacking(tables["papers"], tables["contributions"]).select(F.col("id").alias("paper_id"), doi_key(F.col("doi")).alias("doi"))
    gaps = fixed(gaps.orderBy("paper_id").limit(limit) if limit else gaps)
    urls = services.pdf_urls.select(doi_key(F.col("doi")).alias("doi"), "url")
    files = pdf.with_cache(urls.join(gaps, "doi", "left_semi"), services.pdf_get, services.pdf_cache)
    pages = pdf.texts(files.filter("error is null")).join(gaps, "doi")
    said = fixed(pdf.predicted_authors(pages, services.predict["pdf"]))
    return pdf.from_pdf(tables, said)
