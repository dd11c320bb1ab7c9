"""How complete the tables are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.functions.normalize import not_blank
from colophon.storage import shuffled


def without_rows(parents: DataFrame, children: DataFrame, key: str, child_key: str) -> DataFrame:
    """Parents that have no child."""
    return parents.join(children, parents[key] == children[child_key], "left_anti")


def never(parents: DataFrame, children: DataFrame, key: str, child_key: str, filled: Column) -> DataFrame:
    """Parents that have children, none of them ``filled``."""
    having = parents.join(children.select(child_key), parents[key] == F.col(child_key), "left_semi")
    done = children.filter(filled).select(child_key)
    return having.join(done, having[key] == F.col(child_key), "left_anti")


def rows_of_never(children: DataFrame, key: str, filled: Column) -> DataFrame:
    """Children of keys of which no row is ``filled``."""
    return children.join(children.filter(filled).select(key).distinct(), key, "left_anti")


def partial_buckets(rows: DataFrame, key: str, missing: Column, most: int = 5) -> DataFrame:
    """``(bucket, papers)``: keys with both kinds of rows, by the number missing, ``most`` and more as one."""
    counts = rows.groupBy(key).agg(F.count_if(missing).alias("missing"), F.count_if(~missing).alias("filled"))
    partial = counts.filter("missing > 0 and filled > 0")
    bucket = F.least("missing", F.lit(most)).cast("int").alias("bucket")
    return partial.groupBy(bucket).agg(F.count(F.lit(1)).alias("papers"))


def top_groups(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The ``n`` commonest values, ties by value."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), key).limit(n)


def percent(part: Column, whole: Column) -> Column:
    """Text with one decimal, ``-`` without a whole."""
    return F.when(whole > 0, F.format_string("%.1f%%", 100.0 * part / whole)).otherwise("-")


def health_report(tables: dict[str, DataFrame]) -> DataFrame:
    """One row of totals: tables, years, abstracts, countries, and papers with gaps."""
    papers, contributions = tables["papers"], tables["contributions"]
    has_institution = F.col("institution_id").isNotNull()
    by_paper = contributions.groupBy("paper_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(has_institution).alias("filled"),
        F.count_if(not_blank(F.col("raw_affiliation_string"))).alias("raw"),
        F.count_if(F.col("country_code").isNotNull()).alias("countries"),
    )
    joined = papers.select("id", "doi", "publication_year", "abstract_text").join(
        shuffled(by_paper), F.col("id") == F.col("paper_id"), "left"
    )
    zero = F.coalesce("filled", F.lit(0)) == 0
    dead = F.col("rows").isNotNull() & zero
    out = joined.agg(
        F.count(F.lit(1)).alias("papers"),
        F.min("publication_year").alias("first_year"),
        F.max("publication_year").alias("last_year"),
        F.count_if(not_blank(F.col("abstract_text"))).alias("abstracts"),
        F.count_if(F.col("countries") > 0).alias("with_country"),
        F.count_if(F.col("rows").isNull()).alias("orphans"),
        F.count_if(dead).alias("all_null"),
        F.count_if(zero).alias("zero_total"),
        F.coalesce(F.sum(F.when(dead, F.col("rows"))), F.lit(0)).alias("rows_dead"),
        F.coalesce(F.sum(F.when(dead, F.col("raw"))), F.lit(0)).alias("rows_imputable"),
        F.count_if(dead & (F.col("raw") > 0)).alias("papers_imputable"),
        F.count_if(zero & not_blank(F.col("doi"))).alias("zero_with_doi"),
    )
    for name in ("authors", "institutions", "countries", "contributions"):
        out = out.crossJoin(tables[name].agg(F.count(F.lit(1)).alias(name)))  # one row each
    return out.withColumns({f"{c}_share": percent(F.col(c), F.col("papers")) for c in ("abstracts", "with_country", "zero_total")})
