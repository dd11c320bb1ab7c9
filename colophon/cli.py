"""Command line: ``python -m colophon.cli COMMAND ...``. Tables are folders of Parquet in ``--db``."""

from __future__ import annotations

import argparse
import json
import sys
from importlib import import_module
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon import settings
from colophon.functions.normalize import doi_key
from colophon.operators import chain, coverage, extract, gate, imports, impute, keywords, overlap, report, sampling, topics, wos
from colophon.operators.ingest import load
from colophon.plans import boolean
from colophon.schemas import TABLES
from colophon.operators.runstats import RunStats, without_sink
from colophon.sources import paged, readers
from colophon.sources.sheets import country_sheets

NAMES = [n for n in TABLES if n != "country_imputation_audit"]


def session() -> SparkSession:
    return SparkSession.builder.appName("colophon").getOrCreate()


def tables(spark: SparkSession, db: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{db}/{n}") for n in NAMES}


def save(made: dict[str, DataFrame], db: str, dry_run: bool = False, stats: RunStats | None = None) -> None:
    """A new version of each table, with the rows of each and what ``stats`` counted; ``dry_run`` writes none."""
    stats = stats or RunStats()
    for name, df in made.items():
        df = stats.watch(f"table {name}", df)
        if dry_run:
            without_sink(df)
        else:
            df.write.mode("errorifexists").parquet(f"{db}/{name}")
    print("\n".join(stats.lines()))


def service(name: str | None):
    """A client, as ``module:function``; none without a name."""
    if not name:
        return None
    module, _, function = name.partition(":")
    return getattr(import_module(module), function)


def given(a) -> tuple[dict, str]:
    """The settings and the linted query of their keywords file."""
    chosen = settings.load(a.config)
    return chosen, gate.checked_query(Path(chosen["keywords_file"]).read_text(encoding="utf-8"))


def init(a) -> int:
    made = settings.write_templates(a.folder, a.force)
    print("\n".join(made) or "nothing written; --force writes over what is there")
    return 0


def validate(a) -> int:
    """Keywords, then topics: their form and, with tables, whether they are known."""
    chosen = settings.load(a.config)
    keywords_file = Path(chosen["keywords_file"])
    faults = boolean.lint(boolean.normalize(keywords_file.read_text(encoding="utf-8"))) if keywords_file.exists() else [f"no file {keywords_file}"]
    good, bad = gate.split_topics(settings.listed(chosen["topics_file"]))
    faults += [f"malformed topic {t!r}" for t in bad]
    if good and a.db and not a.no_api:
        spark = session()
        known = tables(spark, a.db)["papers"].select(F.col("primary_topic_id").alias("topic_id"))
        asked = spark.createDataFrame([(t,) for t in good], "topic_id string")
        faults += [f"unknown topic {r['topic_id']}" for r in boolean.topics_exist(asked, known).filter("not exists").orderBy("topic_id").collect()]
    print("\n".join(faults) or "no fault")
    return int(bool(faults))


def convert(a) -> int:
    stats = RunStats()
    save(load(readers.works(session(), a.input), stats=stats), a.db, a.dry_run, stats)
    return 0


def check_db(a) -> int:
    found = tables(session(), a.db)
    report.health_rows(found).orderBy("at").drop("at").show(100, truncate=False)
    coverage.top_groups(found["papers"], "primary_topic_name").show(truncate=60)
    return 0


def found_papers(a, with_topics: bool) -> tuple[dict, DataFrame]:
    """The settings, and the papers that their query (and topics) find."""
    chosen, query = given(a)
    good, bad = gate.split_topics(settings.listed(chosen["topics_file"])) if with_topics else ([], [])
    if bad:
        print(f"malformed topics left out: {', '.join(bad)}")
    if with_topics and not good:
        raise gate.Rejected("no topics")
    filters = chosen["filters"]
    papers = tables(session(), a.db)["papers"]
    return chosen, boolean.filter_works(papers, query, good, filters["date_from"], filters["date_to"], filters["doc_types"])


def searched(a, with_topics: bool) -> int:
    """Count what a search finds, then hold it against the anchors; ``--dry-run`` checks the inputs alone."""
    if a.dry_run:
        chosen, _ = given(a)
        if with_topics and not gate.split_topics(settings.listed(chosen["topics_file"]))[0]:
            raise gate.Rejected("no topics")
        print("inputs are valid")
        return 0
    chosen, found = found_papers(a, with_topics)
    print(f"{found.count()} papers")
    gate.enforce_anchors(found, settings.listed(chosen["anchor_file"])).show(truncate=False)
    return 0


def check_anchor(a) -> int:
    chosen, found = found_papers(a, not a.no_topics)
    gate.enforce_anchors(found, settings.listed(chosen["anchor_file"])).show(truncate=False)
    return 0


def get_topics(a) -> int:
    papers = tables(session(), a.db)["papers"]
    groups = topics.distribution(papers, "primary_topic_id").withColumnRenamed("primary_topic_id", "topic_id")
    if a.filter_topics:
        groups = groups.filter(F.col("topic_id").isin(settings.listed(a.filter_topics)))
    text = F.lit(None).cast("string")
    first = papers.filter("primary_topic_id is not null").groupBy(F.col("primary_topic_id").alias("topic_id"))
    known = first.agg(*[F.min(f"primary_topic_{c}").alias(n) for c, n in (("name", "display_name"), ("domain", "domain"), ("field", "field"), ("subfield", "subfield"))])
    known = known.select("*", text.alias("description"), F.lit(None).cast("array<string>").alias("keywords"))
    kind, rows = report.shown_topics(report.topic_table(groups, known), a.details, a.csv or bool(a.output))
    if kind == "file":
        readers.write_csv(rows, a.output or "topics.csv")
    else:
        rows.select("topic_id", "display_name", "paper_count", "percentage").show(rows.count(), truncate=False)
    return 0


def topic_search(a) -> int:
    """Topics of the papers in a list of DOIs, held against the topics file."""
    spark = session()
    dois = readers.doi_list(spark, a.doi_file).withColumn("key", doi_key(F.col("doi")))
    works = readers.works(spark, a.input).select(doi_key(F.col("doi")).alias("key"), "topics").dropDuplicates(["key"])
    current = spark.createDataFrame([(t,) for t in settings.listed(a.topics_file)], "topic_id string")
    readers.write_csv(report.missing_topic_table(works, dois, current), a.output)
    return 0


def sample(a) -> int:
    papers = tables(session(), a.db)["papers"]
    strata = papers.select("primary_topic_id").distinct().count()
    picked = sampling.sample(papers, a.size, "id", "primary_topic_id", "reservoir" if a.reservoir else a.mode, a.seed, strata)
    found = report.sample_table(picked)
    report.relevance_summary(found).show()
    readers.write_csv(found, a.output) if a.output else found.show(a.size, truncate=80)
    return 0


def download(a) -> int:
    """Records of the query by batches of topics, as JSON lines; a broken run goes on where it was."""
    chosen, query = given(a)
    topic_ids = [] if a.no_topics else gate.split_topics(settings.listed(chosen["topics_file"]))[0]
    filters = chosen["filters"]
    parts = paged.batches(topic_ids, chosen["collection"]["batch_size_topics"])
    texts = [boolean.filter_text(query, p, filters["date_from"], filters["date_to"], filters["doc_types"]) for p in parts]
    print(f"{paged.download(session(), service(a.client), texts, a.output)} batches done now, {len(texts)} in all")
    return 0


def import_wos(a) -> int:
    """Country spreadsheets of a folder overlaid on the tables; a new version in ``--output``."""
    spark = session()
    made = imports.evolved(tables(spark, a.db))
    sheet = country_sheets(spark, a.dir, list(wos.COLUMNS), a.only, a.limit_files, a.limit_rows_per_file)
    stats = RunStats()
    made["papers"], made["contributions"] = wos.overlay(
        made["papers"], made["contributions"], wos.records(sheet), stats, threshold=a.fuzzy_threshold, fuzzy=not a.no_fuzzy
    )
    save(made, a.output, a.dry_run, stats)
    return 0


def sheet_records(a) -> DataFrame:
    sheet = readers.table_csv(session(), a.csv).withColumn("ordinal", F.monotonically_increasing_id())
    return wos.records(sheet.orderBy("ordinal").limit(a.limit) if a.limit else sheet)


def import_csv(a) -> int:
    """A sheet's new records, with what the catalog knows of them; then, if asked for, the stages."""
    made = tables(session(), a.db)
    if a.dry_run:
        print(f"{imports.new_records(made, sheet_records(a)).count()} new records")
        return 0
    made, counts = imports.import_records(made, sheet_records(a), service(a.client))
    counts = counts.first()
    print(counts)
    if a.stages and not a.no_impute and not counts["aborted"] and counts["catalog_records"]:
        made, made["country_imputation_audit"] = chain.by_stages(made, impute.stages(a.stages), predictors(a), asking=asking(a))
    save(made, a.output)
    return int(counts["aborted"])


def predictors(a) -> dict:
    """A predictor for each stage from ``--model``, a function of prompt and length."""
    complete = service(a.model)
    return {s: extract.predictor(complete, s) for s in "123"} | {"pdf": extract.page_predictor(complete)} if complete else {}


def services_of(a, names: tuple[str, ...]) -> chain.Services:
    asked = {n: service(getattr(a, n, None)) for n in names if n in ("catalog", "crossref", "scholar", "pdf_get")}
    if "pdf_get" in names and a.pdf_urls:
        asked |= {"pdf_urls": session().read.parquet(a.pdf_urls), "pdf_cache": a.cache_dir}
    return chain.Services(**asked, predict=predictors(a))


def asking(a) -> chain.Asking:
    """How predictions are asked for and which count, of the options a command has."""
    return chain.Asking(a.min_confidence, a.batch_size, a.match_threshold, service(a.embed), a.vector_cache)


def impute_some(*names: str):
    """A command that fills gaps from the services named, then by ``--stages`` where it has them."""

    def run(a) -> int:
        made = imports.evolved(tables(session(), a.db))
        before = made["contributions"].filter("country_code is not null").count()
        stages = impute.stages(a.stages) if getattr(a, "stages", None) else []
        stats = RunStats()
        made, log = chain.impute_all(made, services_of(a, names), stages, a.limit, asking(a), stats)
        print(f"rows with country: {before} before, {made['contributions'].filter('country_code is not null').count()} after")
        save(made | {"country_imputation_audit": log}, a.output, a.dry_run, stats)
        return 0

    return run


def compare_dois(a) -> int:
    spark = session()
    ours = overlap.key_set(tables(spark, a.db)["papers"], doi_key(F.col("doi")))
    sheet = readers.table_csv(spark, a.csv)
    overlap.report(ours, overlap.key_set(sheet, doi_key(F.col("DOI")))).show(vertical=True)
    if a.export:
        theirs, own = report.doi_differences(ours, sheet, doi_key(F.col("DOI")))
        readers.write_csv(theirs, f"{a.export}/only_in_sheet")
        readers.write_csv(own, f"{a.export}/only_in_tables")
    return 0


def extract_keywords(a) -> int:
    rows = readers.sniffed(session(), a.file).withColumn("_n", F.monotonically_increasing_id())
    docs = keywords.documents(rows, "_n", a.title, a.abstract)
    scored = keywords.mean_tfidf(docs, a.ngram_min, a.ngram_max, a.min_df, a.max_df)
    embed = service(a.embed)
    if embed:
        pool = keywords.top(scored, "score", a.candidate_pool)
        vectors = extract.embedded(pool.select("term"), "term", embed), extract.embedded(docs, "text", embed)
        kept = pool.join(keywords.mean_similarity(*vectors).withColumnRenamed("score", "keybert_score"), "term")
        scored = keywords.blend(kept.withColumnRenamed("score", "tfidf_score"), alpha=a.alpha)
    table = report.keyword_table(keywords.top(scored, "combined_score" if embed else "score", a.top_n))
    table.show(a.top_n, truncate=False)
    if a.output and not a.no_write:
        report.write_keywords(table, a.output, a.format, a.force)
    return 0


def build_query(a) -> int:
    query = boolean.bounded_query(json.loads(Path(a.json).read_text(encoding="utf-8")))
    print(query)
    if a.output and not a.no_write:
        report.write_query(query, a.output, a.json, a.force)
    return 0


def export_format(a) -> int:
    print("nothing to export: tables are Parquet already")
    return 0


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="colophon")
    commands = top.add_subparsers(required=True)

    def add(name: str, run, *arguments: tuple, db: bool = True):
        p = commands.add_parser(name)
        if db:
            p.add_argument("--db", required=True)
        for flags, options in arguments:
            p.add_argument(*flags.split(), **options)
        p.set_defaults(run=run)

    dry, config = ("--dry-run", {"action": "store_true"}), ("--config", {"default": "config/collection.yml"})
    output, limit = ("--output", {"required": True}), ("--limit", {"type": int})
    flag, number = {"action": "store_true"}, {"type": int}
    add("init", init, ("--folder", {"default": "config"}), ("--force", flag), db=False)
    add("validate", validate, config, ("--db", {}), ("--no-api", flag), db=False)
    add("convert-to-db", convert, ("--input", {"required": True}), dry)
    add("check-db", check_db)
    add("search", lambda a: searched(a, False), config, dry)
    add("search-filtered", lambda a: searched(a, True), config, dry)
    add("check-anchor", check_anchor, config, ("--no-topics", flag))
    add("get-topics", get_topics, ("--details", flag), ("--csv", flag), ("--filter-topics", {}), ("--output", {}))
    add("topic-search", topic_search, ("--doi-file", {"default": "config/missing_dois.txt"}), ("--input", {"required": True}),
        ("--topics-file", {"default": "config/topics.txt"}), ("--output", {"default": "missing_topic_analysis.csv"}), db=False)
    add("sample", sample, ("--size", {"type": int, "required": True}), ("--seed", {"type": int, "default": 42}), ("--reservoir", flag),
        ("--mode", {"default": "auto", "choices": ["auto", "exact", "reservoir", "stratified"]}), ("--output", {}))
    add("download", download, config, ("--client", {"required": True}), ("--no-topics", flag), output, db=False)
    add("compare-dois", compare_dois, ("--csv", {"required": True}), ("--export", {}))
    add("import-wos", import_wos, ("--dir", {"default": "data/QSM"}), ("--only", {}), ("--limit-files", number), ("--limit-rows-per-file", number),
        ("--fuzzy-threshold", {"type": float, "default": 0.95}), ("--no-fuzzy", flag), output, dry)
    sheet = ("csv", {}), ("--client", {}), ("--no-impute", flag), output, limit, dry
    add("extract-keywords", extract_keywords, ("file", {}), ("--title", {"default": "Article Title"}), ("--abstract", {"default": "Abstract"}),
        ("--top-n", {"type": int, "default": 50}), ("--ngram-min", {"type": int, "default": 2}), ("--ngram-max", {"type": int, "default": 3}),
        ("--min-df", {"type": int, "default": 2}), ("--max-df", {"type": float, "default": 0.85}), ("--embed", {}), ("--candidate-pool", {"type": int, "default": 200}),
        ("--alpha", {"type": float, "default": 0.5}), ("--format", {"default": "json", "choices": ["json", "csv", "txt"]}), ("--output", {}),
        ("--no-write", flag), ("--force", flag), db=False)
    add("build-categorized-query", build_query, ("json", {}), ("--output", {}), ("--no-write", flag), ("--force", flag), db=False)
    add("export-format", export_format, db=False)
    model = ("--model", {}), ("--min-confidence", {"type": float, "default": 0.8}), ("--batch-size", {"type": int, "default": 20})
    model += ("--match-threshold", {"type": float, "default": 0.78}), ("--embed", {}), ("--vector-cache", {"default": ""})
    common = output, limit, dry, *model
    add("import-wos-csv", import_csv, *sheet, *model, ("--stages", {"default": ""}))
    add("wos-import-impute", import_csv, *sheet, *model, ("--stages", {"default": "1,2,3"}))
    stages, pdf = ("--stages", {"default": "1,2,3"}), (("--pdf-get", {}), ("--pdf-urls", {}), ("--cache-dir", {"default": "data/pdf"}))
    catalog, crossref, scholar = (("--" + n, {}) for n in ("catalog", "crossref", "scholar"))
    add("impute-all", impute_some("catalog", "crossref", "scholar", "pdf_get"), *common, stages, catalog, crossref, scholar, *pdf)
    add("impute-catalog", impute_some("catalog"), *common, catalog)
    for name in ("impute-crossref", "enrich-crossref"):
        add(name, impute_some("crossref"), *common, crossref)
    add("impute-scholar", impute_some("scholar"), *common, scholar)
    for name in ("impute-llm", "impute-affiliation"):
        add(name, impute_some(), *common, stages)
    add("impute-pdf", impute_some("pdf_get"), *common, *pdf)
    return top


def main(arguments: list[str] | None = None) -> int:
    chosen = parser().parse_args(arguments)
    try:
        return chosen.run(chosen)
    except gate.Rejected as why:
        print(why)
        return 1


if __name__ == "__main__":
    sys.exit(main())
