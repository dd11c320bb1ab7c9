"""Spreadsheet records overlaid on the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.functions.normalize import blank_to_null, doi_key, strip_space, stub_id, title_key, top_flag, whole_number
from colophon.operators.ingest import first_of, insert_absent, merge_flags
from colophon.operators.matching import cascade_match, fuzzy_match, lookup
from colophon.operators.runstats import RunStats, watched

COLUMNS = (
    "Accession Number", "DOI", "Article Title", "Authors", "Source", "Document Type", "Publication Date", "Times Cited",
    "Top 1%", "Top 10%", "Percentile in Subject Area",
)
NULL_TOKENS = ["n/a", "N/A", "na", "null", ""]


def null_tokens(df: DataFrame, tokens: list[str] = NULL_TOKENS) -> DataFrame:
    """``df`` with null for each of several tokens in its text columns."""
    texts = [c for c, kind in df.dtypes if kind == "string"]
    return df.withColumns({c: F.when(~F.col(f"`{c}`").isin(*tokens), F.col(f"`{c}`")) for c in texts})


def records(sheet: DataFrame) -> DataFrame:
    """The fields of a sheet, typed; values that can't be read are null, flags false."""

    def column(name: str) -> Column:
        return F.col(f"`{name}`") if name in sheet.columns else F.lit(None).cast("string")

    def text(name: str) -> Column:
        return blank_to_null(strip_space(column(name).cast("string")))

    return sheet.select(
        text("Accession Number").alias("accession_number"),
        text("DOI").alias("doi_raw"),
        doi_key(column("DOI").cast("string")).alias("doi"),
        text("Article Title").alias("title"),
        title_key(column("Article Title").cast("string")).alias("title_key"),
        text("Authors").alias("authors"),
        text("Source").alias("source"),
        text("Document Type").alias("document_type"),
        whole_number(column("Publication Date").cast("string")).alias("year"),
        whole_number(column("Times Cited").cast("string")).alias("times_cited"),
        top_flag(column("Top 1%").cast("string")).alias("top_1"),
        top_flag(column("Top 10%").cast("string")).alias("top_10"),
        column("Percentile in Subject Area").cast("string").try_cast("double").alias("percentile"),
        *[F.col(c) for c in ("ordinal", "country_code") if c in sheet.columns],
    )


def match(rows: DataFrame, papers: DataFrame, threshold: float = 0.95, fuzzy: bool = True) -> DataFrame:
    """Records (with ``ordinal``) with ``match_id`` and method: DOI (last paper), title (first), similar title, new."""
    base = papers.select(
        "id", doi_key(F.col("doi")).alias("doi"), title_key(F.col("title")).alias("title_key"), "publication_year", F.col("id").alias("ordinal")
    )
    out = cascade_match(rows, base, [("doi", "doi", True), ("title_key", "title_exact", False)])
    if not fuzzy:
        return out
    left = out.filter("match_id is null and title_key is not null")
    queries = left.select(F.col("ordinal").alias("id"), F.col("title_key").alias("title"), "year")
    # a title stands for its first paper, whose year decides
    titles = lookup(base, "title_key", "ordinal").select("id", F.col("title_key").alias("title"), F.col("publication_year").alias("year"))
    found = fuzzy_match(queries, titles, threshold)
    out = out.join(found, out["ordinal"] == found["query_id"], "left")
    label = F.concat(F.lit("title_fuzzy:"), F.floor("score").cast("int").cast("string"))
    return out.withColumns(
        {"match_id": F.coalesce("match_id", "base_id"), "match_method": F.coalesce(label, "match_method")}
    ).drop("query_id", "base_id", "score")


def with_paper(found: DataFrame) -> DataFrame:
    """Matched records with ``paper_id``; new ones share the stub of the first with their DOI, else title, else number."""
    key = F.coalesce(F.concat(F.lit("d:"), "doi"), F.concat(F.lit("t:"), "title_key"), F.concat(F.lit("a:"), "accession_number"))
    keyed = found.withColumn("_key", F.when(F.col("match_id").isNull(), key))
    first = first_of(keyed.filter("_key is not null"), ["_key"], ["ordinal"])
    first = first.select(F.col("_key").alias("_new"), stub_id(F.col("accession_number"), F.col("title")).alias("_stub"))
    out = keyed.join(first, F.col("_key") == F.col("_new"), "left")
    return out.withColumn("paper_id", F.coalesce("match_id", "_stub")).drop("_key", "_new", "_stub")


def stubs(named: DataFrame) -> DataFrame:
    """Papers for records without a match, from ``with_paper``."""
    new = first_of(named.filter("match_id is null and paper_id is not null"), ["paper_id"], ["ordinal"])
    return new.select(
        F.col("paper_id").alias("id"),
        "doi",
        F.coalesce("title", F.lit("Untitled")).alias("title"),
        F.col("year").alias("publication_year"),
        F.col("document_type").alias("type"),
        F.col("source").alias("journal_name"),
        F.col("times_cited").alias("cited_by_count"),
        F.col("percentile").alias("citation_percentile"),
        F.col("top_1").alias("is_top_1_percent"),
        F.col("top_10").alias("is_top_10_percent"),
        F.lit(True).alias("from_wos"),
        F.col("accession_number").alias("wos_accession_number"),
    )


def overlay(papers: DataFrame, contributions: DataFrame, rows: DataFrame, stats: RunStats | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """Papers and contributions with a sheet's records: flags, stubs, and a marker for each country.

    ``stats`` get the records by how they were matched, and how many of them named no paper.
    """
    method = F.split("match_method", ":")[0]
    outcomes = {n: F.count_if(method == m) for n, m in (("by_doi", "doi"), ("by_title", "title_exact"), ("by_similar_title", "title_fuzzy"), ("new", "new"))}
    found = watched(stats, "records", with_paper(match(rows, papers, **options)), **outcomes, unnamed=F.count_if(F.col("paper_id").isNull()))
    hits = found.filter("match_id is not null").select(
        F.col("match_id").alias("id"),
        F.col("top_1").alias("is_top_1_percent"),
        F.col("top_10").alias("is_top_10_percent"),
        F.lit(True).alias("from_wos"),
        F.col("accession_number").alias("wos_accession_number"),
        "ordinal",
    )
    flags = ["is_top_1_percent", "is_top_10_percent", "from_wos"]
    marked = merge_flags(papers, hits, "id", flags, ["wos_accession_number"], "ordinal")
    out = insert_absent(marked, stubs(found), ["id"])
    wanted = found.filter("country_code is not null and paper_id is not null").select("paper_id", "country_code").distinct()
    there = contributions.filter("source = 'wos'").select("paper_id", "country_code")
    new = wanted.join(there, ["paper_id", "country_code"], "left_anti").withColumn("source", F.lit("wos"))
    new = watched(stats, "markers", new)
    return out, contributions.unionByName(new, allowMissingColumns=True)
