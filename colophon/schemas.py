"""Schemas of work records and of the tables made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORK = (
    "id string, doi string, title string, type string, publication_year int, publication_date string,"
    " updated_date string, primary_location struct<source: struct<display_name: string, issn_l: string,"
    " is_core: boolean, host_organization_name: string>, pdf_url: string>,"
    " open_access struct<is_oa: boolean, oa_status: string, oa_url: string>, cited_by_count int, fwci double,"
    " citation_normalized_percentile struct<value: double, is_in_top_1_percent: boolean, is_in_top_10_percent: boolean>,"
    " primary_topic struct<id: string, display_name: string, score: double, subfield: struct<display_name: string>,"
    " field: struct<display_name: string>, domain: struct<display_name: string>>,"
    " topics array<struct<id: string, display_name: string, subfield: struct<display_name: string>,"
    " field: struct<display_name: string>, domain: struct<display_name: string>>>,"
    " institutions_distinct_count int, countries_distinct_count int,"
    " abstract_inverted_index map<string, array<int>>,"
    " authorships array<struct<author: struct<id: string, display_name: string, orcid: string>,"
    " institutions: array<struct<id: string, display_name: string, country_code: string, type: string, ror: string>>,"
    " countries: array<string>, raw_author_name: string, author_position: string, is_corresponding: boolean,"
    " raw_affiliation_strings: array<string>>>, _corrupt_record string"
)
TABLES = {
    "papers": "id string, doi string, title string, publication_year int, publication_date string, type string,"
    " journal_name string, journal_issn string, is_core_journal boolean, publisher string, is_oa boolean,"
    " oa_status string, oa_url string, cited_by_count int, citation_percentile double, is_top_1_percent boolean,"
    " is_top_10_percent boolean, fwci double, primary_topic_id string, primary_topic_name string,"
    " primary_topic_score double, primary_topic_field string, primary_topic_subfield string,"
    " primary_topic_domain string, institutions_distinct_count int, countries_distinct_count int,"
    " is_international boolean, abstract_text string, updated_date string",
    "authors": "id string, display_name string, orcid string",
    "institutions": "id string, display_name string, country_code string, type string, ror_id string, is_synthetic boolean",
    "countries": "id int, country_name string, country_code string, status int",
    "contributions": "row_id long, paper_id string, author_id string, institution_id string, country_code string,"
    " author_name string, author_position string, is_corresponding boolean, raw_affiliation_string string",
    "country_imputation_audit": "run_at timestamp, row_id long, paper_id string, inferred_country_code string,"
    " matched_terms string, raw_affiliation_string string, source string, confidence double, stage string",
}
LATER_COLUMNS = {
    "papers": {"from_wos": "false", "wos_accession_number": "cast(null as string)", "source": "'catalog'"},
    "contributions": {"source": "'catalog'"},
    "institutions": {"is_synthetic": "false"},
}


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name])


def evolve(df: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """``df`` with the columns it lacks, and defaults where values are null."""
    for name, sql in defaults.items():
        default = F.expr(sql)
        df = df.withColumn(name, F.coalesce(F.col(name), default) if name in df.columns else default)
    return df
