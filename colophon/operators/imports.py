"""Spreadsheet records taken in with what a service knows of them, and papers asked for again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.functions.normalize import doi_key, last_segment
from colophon.operators import ingest, overlap, wos
from colophon.operators.impute import papers_lacking
from colophon.schemas import LATER_COLUMNS, evolve
from colophon.sources.lookup import answered_works, works_by_doi, works_by_title
from colophon.sources.paged import Fetch
from colophon.storage import fixed

Tables = dict[str, DataFrame]


def evolved(tables: Tables) -> Tables:
    return tables | {n: evolve(tables[n], LATER_COLUMNS[n]) for n in LATER_COLUMNS}


def taken_in(tables: Tables, answers: DataFrame, from_sheet: bool) -> tuple[Tables, DataFrame]:
    """The tables with the works of ``answers``, marked as the catalog's, and the ids of these works."""
    works = fixed(answered_works(answers))
    ids = works.select(last_segment(F.col("id")).alias("_id")).filter("_id is not null").distinct()
    out = evolved(ingest.load(works, tables))
    marked = out["papers"].join(ids, F.col("id") == F.col("_id"), "left")
    hit = F.col("_id").isNotNull()
    marks = {"source": F.when(hit, "catalog").otherwise(F.col("source"))}
    if from_sheet:
        marks["from_wos"] = hit | F.col("from_wos")
    return out | {"papers": marked.withColumns(marks).select(*out["papers"].columns)}, ids


def import_records(tables: Tables, records: DataFrame, fetch: Fetch) -> tuple[Tables, DataFrame]:
    """The tables with a sheet's new ``records`` (with ``ordinal``), and one row of counts.

    Records whose DOI a paper has are known. The others are asked for by DOI; those that the
    service doesn't know, or that have no DOI, become stubs. Records of failed requests do not:
    the next run asks for them again, and ``aborted`` says so.
    """
    tables = evolved(tables)
    known = overlap.key_set(tables["papers"], doi_key(F.col("doi")))
    new = fixed(overlap.absent_rows(records, F.col("doi"), known))
    answers = fixed(works_by_doi(overlap.key_set(new, F.col("doi")), fetch))
    out, ids = taken_in(tables, answers, from_sheet=True)
    status = answers.groupBy(F.col("asked").alias("_asked")).agg(F.max("status").alias("status"))  # ok is the largest
    marked = fixed(ingest.left_join(new, status, "doi", "_asked").drop("_asked"))
    lost = marked.filter("doi is null or status = 'not_found'")
    named = wos.with_paper(lost.withColumns({"match_id": F.lit(None).cast("string"), "match_method": F.lit("new")}))
    stubs = fixed(wos.stubs(named).withColumn("source", F.lit("wos")))
    papers = ingest.insert_absent(out["papers"], stubs, ["id"])
    counts = marked.agg(
        F.count(F.lit(1)).alias("candidates"),
        F.count("doi").alias("with_doi"),
        F.count_if(F.col("status") == "ok").alias("found"),
        F.count_if(F.col("status") == "not_found").alias("not_found"),
        F.count_if(F.col("doi").isNull()).alias("no_doi"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )
    one = F.count(F.lit(1))  # one row each
    counts = counts.crossJoin(ids.agg(one.alias("catalog_records"))).crossJoin(stubs.agg(one.alias("stubs")))
    return out | {"papers": papers}, counts.withColumn("aborted", F.col("failed") > 0)


def new_records(tables: Tables, records: DataFrame) -> DataFrame:
    """What ``import_records`` would ask for: the dry run."""
    return overlap.absent_rows(records, F.col("doi"), overlap.key_set(tables["papers"], doi_key(F.col("doi"))))


def ask_again(tables: Tables, fetch: Fetch, limit: int | None = None) -> tuple[Tables, DataFrame]:
    """Papers with gaps asked for by DOI, else by title: the tables, and counts by ``status``."""
    tables = evolved(tables)
    gaps = papers_lacking(tables["papers"], tables["contributions"], title_ok=True).select("id", doi_key(F.col("doi")).alias("doi"), "title")
    gaps = gaps.orderBy("id").limit(limit) if limit else gaps
    by_doi = works_by_doi(overlap.key_set(gaps, F.col("doi")), fetch)
    by_title = works_by_title(gaps.filter("doi is null").select(F.col("title").alias("key")).distinct(), fetch)
    answers = fixed(by_doi.unionByName(by_title))
    out, _ = taken_in(tables, answers, from_sheet=False)
    return out, answers.groupBy("status").agg(F.countDistinct("asked").alias("n"))
