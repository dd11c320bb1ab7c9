"""Tables in the form in which they leave."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.functions.normalize import last_segment
from colophon.operators import coverage, keywords, sampling
from colophon.operators.topics import describe, missing_topics

SHOWN_TOPICS, MOST_LISTED = 20, 50


def topic_table(groups: DataFrame, details: DataFrame) -> DataFrame:
    """Nine columns from groups (topic_id, paper_count, percentage) and what is known of topics."""
    named = describe(groups, details)
    return named.select("topic_id", "display_name", "description", "keywords", "domain", "field", "subfield", "paper_count", "percentage").orderBy(F.desc("paper_count"), "topic_id")


def shown_topics(groups: DataFrame, details: bool = False, as_file: bool = False) -> tuple[str, DataFrame]:
    """How a list of topics is given: ``file`` or ``screen``, and which rows of it."""
    many = groups.count() > MOST_LISTED
    if as_file or (details and many):
        return "file", groups
    return "screen", groups if details else groups.limit(SHOWN_TOPICS)


def sample_table(papers: DataFrame) -> DataFrame:
    """Fourteen columns of sampled papers, with their relevance."""
    text = F.concat_ws(" ", "title", "abstract_text", "primary_topic_name")
    marked = papers.withColumn("_r", sampling.relevance(text))
    return marked.select(
        "id", "doi", "title", "publication_year", "type",
        F.col("primary_topic_id").alias("topic_id"), F.col("primary_topic_name").alias("topic_name"), F.coalesce("abstract_text", F.lit("")).alias("abstract_text"),
        "cited_by_count", "fwci", F.col("institutions_distinct_count").alias("institutions_count"), F.col("countries_distinct_count").alias("countries_count"),
        "_r.relevance", "_r.rationale",
    )


def relevance_summary(sampled: DataFrame) -> DataFrame:
    """``(relevance, n, share)``."""
    counts = sampled.groupBy("relevance").agg(F.count(F.lit(1)).alias("n"))
    total = sampled.agg(F.count(F.lit(1)).alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("relevance", "n", coverage.percent(F.col("n"), F.col("total")).alias("share"))  # one row


def missing_topic_table(works: DataFrame, dois: DataFrame, current: DataFrame) -> DataFrame:
    """Topics of the works that a list of DOIs names, most frequent first.

    ``works``: key (normal DOI) and topics, as in work records. ``dois``: key, doi and pos. ``current``: topic_id.
    """
    asked = dois.join(works, "key").select("doi", "pos", F.posexplode("topics").alias("at", "t"))
    name = {"topic": "t.display_name", "subfield": "t.subfield.display_name", "field": "t.field.display_name", "domain": "t.domain.display_name"}
    rows = asked.select(last_segment(F.col("t.id")).alias("topic_id"), "doi", F.struct("pos", "at").alias("order"), *[F.coalesce(p, F.lit("")).alias(n) for n, p in name.items()])
    found = missing_topics(rows, dois.count(), current, "topic_id", "order", "doi", tuple(name))
    titles = {"topic_id": "Topic ID", "topic": "Topic", "subfield": "Subfield", "field": "Field", "domain": "Domain", "frequency": "Frequency"}
    titles |= {"coverage": "Coverage %", "importance": "Importance", "status": "Status", "example": "Example DOI"}
    return found.orderBy(F.desc("frequency"), "topic_id").select(*[F.col(c).alias(t) for c, t in titles.items()])


def keyword_table(scored: DataFrame) -> DataFrame:
    """``(rank, term, score)`` or, after a second scoring, its four scores in place of one; six decimals."""
    scores = [c for c in ("score", "tfidf_score", "keybert_score", "combined_score") if c in scored.columns]
    out = keywords.ranked(scored.select("term", *scores), scores[-1])
    return out.select("rank", "term", *[F.round(c, 6).alias(c) for c in scores])


def write_keywords(table: DataFrame, path: str, form: str = "json", force: bool = False) -> None:
    """A short list as one file: JSON, CSV with six decimals, or the terms alone."""
    target = Path(path)
    if target.exists() and not force:
        raise FileExistsError(path)
    rows = [r.asDict() for r in table.orderBy("rank").collect()]  # a top list
    if form == "json":
        text = json.dumps(rows, ensure_ascii=False, indent=2)
    elif form == "csv":
        lines = [table.columns] + [[f"{v:.6f}" if isinstance(v, float) else str(v) for v in r.values()] for r in rows]
        text = "\n".join(",".join(f'"{c}"' if "," in c else c for c in line) for line in lines) + "\n"
    elif form == "txt":
        text = "".join(f"{r['term']}\n" for r in rows)
    else:
        raise ValueError("forms are json, csv and txt")
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(text, encoding="utf-8")


def write_query(query: str, path: str, source: str, force: bool = False) -> None:
    """A query's file, under comment lines that say where it comes from."""
    target = Path(path)
    if target.exists() and not force:
        raise FileExistsError(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(f"# made from {source}\n# core or methods; mechanisms only with applications\n{query}\n", encoding="utf-8")


def doi_differences(ours: DataFrame, rows: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
    """A sheet's whole rows that the papers lack, and the papers' DOIs that the sheet lacks, sorted."""
    from colophon.operators import overlap

    theirs = overlap.key_set(rows, key)
    return overlap.rows_only_theirs(rows, key, ours), overlap.only_in(ours, theirs).withColumnRenamed("key", "doi")


def health_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """``(at, metric, count, share)``: the report's lines in the order in which they are shown."""
    missing = F.col("institution_id").isNull()
    buckets = coverage.partial_buckets(tables["contributions"], "paper_id", missing)
    per_bucket = buckets.agg(F.sum("papers").alias("partial"), *[F.sum(F.when(F.col("bucket") == k, F.col("papers"))).alias(f"partial_{k}") for k in range(1, 6)])
    whole = coverage.health_report(tables).crossJoin(per_bucket)  # one row each
    years = F.concat_ws(" – ", F.col("first_year").cast("string"), F.col("last_year").cast("string"))
    dead = F.col("rows_dead") - F.col("rows_imputable")
    lines: list[tuple[str, Column | str, Column | str | None]] = [
        ("Papers", "papers", "papers"),
        ("Years", years, None),
        ("Authors", "authors", None),
        ("Institutions", "institutions", None),
        ("Countries", "countries", None),
        ("Contributions", "contributions", None),
        ("Papers with abstract", "abstracts", "papers"),
        ("Papers with country", "with_country", "papers"),
        ("Papers without any institution", "zero_total", "papers"),
        ("  without contributions", "orphans", "papers"),
        ("  no contribution has an institution", "all_null", "papers"),
        ("  contributions of these papers", "rows_dead", None),
        ("    with an affiliation text", "rows_imputable", "rows_dead"),
        ("    without one", dead, "rows_dead"),
        ("  with a row to impute", "papers_imputable", "zero_total"),
        ("  with DOI", "zero_with_doi", "zero_total"),
        ("  without DOI", F.col("zero_total") - F.col("zero_with_doi"), "zero_total"),
        ("Papers with institutions in part", F.coalesce("partial", F.lit(0)), "papers"),
        *[(f"  {k}{'+' * (k == 5)} missing", F.coalesce(f"partial_{k}", F.lit(0)), None) for k in range(1, 6)],
    ]

    def line(at: int, name: str, value: Column | str, of: str | None) -> Column:
        value = F.col(value) if isinstance(value, str) else value
        share = coverage.percent(value, F.col(of)) if of else F.lit("")
        return F.struct(F.lit(at).alias("at"), F.lit(name).alias("metric"), value.cast("string").alias("count"), share.alias("share"))

    return whole.select(F.inline(F.array(*[line(k, *x) for k, x in enumerate(lines, 1)])))
