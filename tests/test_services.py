import io
import json
import sys
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import services

from colophon import cli, settings
from colophon.operators import chain, extract, gate, imports, impute, ingest, pdf, report, wos
from colophon.plans import boolean
from colophon.sources import lookup, paged, readers, sheets


def book(rows, shared=True):
    """A spreadsheet with one sheet."""
    texts, cells = [], []
    for r, row in enumerate(rows, 1):
        line = ""
        for c, value in enumerate(row):
            at = f"{chr(65 + c)}{r}"
            if value is None:
                continue
            if isinstance(value, str) and shared:
                texts.append(value)
                line += f'<c r="{at}" t="s"><v>{len(texts) - 1}</v></c>'
            elif isinstance(value, str):
                line += f'<c r="{at}" t="inlineStr"><is><t>{value}</t></is></c>'
            else:
                line += f'<c r="{at}"><v>{value}</v></c>'
        cells.append(f'<row r="{r}">{line}</row>')
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {space}><sheetData>{''.join(cells)}</sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {space}>{''.join(f'<si><t>{t}</t></si>' for t in texts)}</sst>")
    return out.getvalue()


HEADER = ["Accession Number", "DOI", "Article Title", "Publication Date", "Top 1%", "Times Cited"]


def tables_of(spark, works):
    lines = spark.createDataFrame([(json.dumps(w), "", k) for k, w in enumerate(works)], "value string, _file string, _line long")
    return ingest.load(readers.parsed_works(lines))


def test_sheets(spark, tmp_path):
    (tmp_path / "France.xlsx").write_bytes(book([HEADER, ["WOS:1", "10.1/1", "One", 2020.0, 1, 42], [None], ["WOS:2", None, "Two", "early", None, 1e12]]))
    (tmp_path / "South Korea.xlsx").write_bytes(book([HEADER, ["WOS:3", "10.1/3", "Three", 2021]], shared=False))
    (tmp_path / "Atlantis.xlsx").write_bytes(book([HEADER, ["WOS:9"]]))
    found = sheets.country_sheets(spark, str(tmp_path), list(wos.COLUMNS))
    rows = wos.records(found).orderBy("ordinal").collect()
    assert [(r["accession_number"], r["doi"], r["year"], r["top_1"], r["times_cited"], r["country_code"]) for r in rows] == [
        ("WOS:1", "10.1/1", 2020, True, 42, "FR"),
        ("WOS:2", None, None, False, None, "FR"),
        ("WOS:3", "10.1/3", 2021, False, None, "KR"),
    ]
    assert sheets.country_sheets(spark, str(tmp_path), ["DOI"], most_files=1, most_rows=1).count() == 1
    assert readers.sniffed(spark, str(tmp_path / "France.xlsx")).columns == HEADER
    with pytest.raises(ValueError):
        sheets.country_sheets(spark, str(tmp_path), ["DOI"], only="Countries Quantum Sensing and Metrology - WoS.xlsx")


def test_import_records(spark):
    tables = tables_of(spark, services.WORKS[:2])
    sheet = [("WOS:1", "https://doi.org/10.1/1", "Known 1"), ("WOS:3", "10.1/3", "Known 3"), ("WOS:4", "10.7/none", "Stub"), ("WOS:5", None, "No doi")]
    rows = spark.createDataFrame(sheet, "`Accession Number` string, DOI string, `Article Title` string").withColumn("ordinal", F.monotonically_increasing_id())
    made, counts = imports.import_records(tables, wos.records(rows), services.fetch)
    got = counts.first().asDict()
    assert got == {"candidates": 3, "with_doi": 2, "found": 1, "not_found": 1, "no_doi": 1, "failed": 0, "catalog_records": 1, "stubs": 2, "aborted": False}
    papers = {r["id"]: r for r in made["papers"].collect()}
    assert set(papers) == {"W1", "W2", "W3", "WOS_4", "WOS_5"}
    assert papers["W3"]["from_wos"] and papers["W3"]["source"] == "catalog" and papers["WOS_4"]["source"] == "wos" and not papers["W1"]["from_wos"]
    assert made["contributions"].filter("paper_id = 'W3'").count() == 1
    again, counts = imports.import_records(made, wos.records(rows), services.fetch)
    assert again["papers"].count() == 5 and counts.first()["candidates"] == 1  # a record without DOI comes again, its stub is there
    bad = rows.withColumn("DOI", F.when(F.col("Accession Number") == "WOS:3", "10.9/fail").otherwise(F.col("DOI")))
    made, counts = imports.import_records(tables, wos.records(bad), services.fetch)
    assert counts.first()["aborted"] and counts.first()["stubs"] == 1


def test_ask_again_and_lookups(spark):
    tables = tables_of(spark, [services.WORKS[1], {"id": "https://x/S1", "title": "Known 5", "authorships": [{"author": {"id": "https://x/A9"}}]}])
    made, counts = imports.ask_again(tables, services.fetch)
    assert {r["status"]: r["n"] for r in counts.collect()} == {"ok": 2}
    assert {r["id"] for r in made["papers"].collect()} == {"W2", "S1", "W5"}
    dois = spark.createDataFrame([("10.1/1",), ("10.1/99",)], "key string")
    assert {(r["asked"], r["status"]) for r in lookup.works_by_doi(dois, services.fetch).collect()} == {("10.1/1", "ok"), ("10.1/99", "not_found")}
    assert boolean.doi_predicate(["10.1/a,b", "10.1/c"]) == "doi:10.1/a%252Cb|10.1/c"
    assert boolean.title_predicate("a b c d e f g h i j k l") == "title.search:a b c d e f g h i j"


def test_download_goes_on_where_it_was(spark, tmp_path):
    filters = [boolean.filter_text("q", [f"T1000{k}"], "2000-01-01") for k in range(3)]
    assert paged.download(spark, services.fetch, filters[:2], str(tmp_path / "d"), wave=1) == 2
    assert paged.download(spark, services.fetch, filters, str(tmp_path / "d")) == 1
    assert paged.download(spark, services.fetch, filters, str(tmp_path / "d")) == 0
    ids = [r["id"] for r in readers.works(spark, str(tmp_path / "d" / "records")).collect()]
    assert sorted(ids) == sorted(w["id"] for w in services.WORKS)
    assert paged.count_topics(services.fetch, lambda p: boolean.filter_text("q", p), ["T10000", "T10001", "T10002"]) == 7
    assert [*next(paged.pages(services.fetch, "x", fields=("id", "doi")))] == ["id", "doi"]
    assert paged.topic_details({"T1": {"display_name": "x"}}.__getitem__, []) == {}


def test_pdf_route(spark, tmp_path):
    assert pdf.first_page_text(services.PDF) == "A (first) page\nTohoku Univ\nJP"
    assert pdf.first_page_text(b"nothing") == "" == pdf.first_page_text(None)
    urls = spark.createDataFrame([("10.1/2", "ok"), ("a", "missing"), ("b", "html"), ("c", "large"), ("d", "down"), ("e", None)], "doi string, url string")
    cache = str(tmp_path / "cache")
    first = {r["doi"]: r["error"] for r in pdf.with_cache(urls, services.get_pdf, cache).collect()}
    assert first == {"10.1/2": None, "a": "http_404", "b": "not_pdf", "c": "too_large", "d": "network"}
    down = lambda url: (500, "", [])
    again = {r["doi"]: r["error"] for r in pdf.with_cache(urls, down, cache).collect()}
    assert again["10.1/2"] is None and again["a"] == "http_500"
    tables = imports.evolved(tables_of(spark, services.WORKS[:2]))
    found = chain.Services(predict={"pdf": extract.page_predictor(services.complete)}, pdf_urls=urls, pdf_get=services.get_pdf, pdf_cache=cache)
    made, log = chain.by_pages(tables, found)
    rows = {r["paper_id"]: r for r in made["contributions"].collect()}
    assert rows["W2"]["country_code"] == "JP" and rows["W2"]["institution_id"].startswith("IMP_") and rows["W1"]["institution_id"] is None
    assert [(r["paper_id"], r["source"], r["stage"]) for r in log.collect()] == [("W2", "pdf", "pdf")]


def test_impute_all(spark):
    tables = tables_of(spark, services.WORKS[:4])
    every = chain.Services(catalog=services.fetch, crossref=services.crossref, predict={s: extract.predictor(services.complete, s) for s in "123"})
    made, log = chain.impute_all(tables, every)
    rows = {r["paper_id"]: r for r in made["contributions"].collect()}
    assert rows["W2"]["raw_affiliation_string"] == "Lab, Japan"  # restored, then predicted
    assert {rows[w]["country_code"] for w in ("W1", "W2", "W3")} == {"FR"} and rows["W4"]["country_code"] is None
    assert made["institutions"].filter("is_synthetic").count() == 1 and log.filter("stage = '1'").count() == 3
    made, log = chain.impute_all(tables, chain.Services(), [3])
    assert [(r["row_id"], r["inferred_country_code"], r["source"]) for r in log.orderBy("row_id").collect()] == [(1, "FR", "rule"), (3, "FR", "rule")]
    assert made["countries"].filter("country_code = 'CN'").count() == 1


def test_answers():
    assert extract.answer_items("no json", "1") == [] == extract.answer_items('{"predictions": 3}', "2")
    got = extract.answer_items('[{"row_id": "7", "country_code": " de "}, {"country_code": "fr"}]', "3")
    assert got == [{"row_id": 7, "country_code": "DE", "status": "none", "confidence": 0.0}]
    assert extract.service_key("my key gsk_aB1 x") == "gsk_aB1" and extract.service_key("") is None


def test_first_prediction_counts(spark):
    rows = [(1, "fr", 0.9, 2), (1, "de", 0.9, 1), (2, "it", 0.1, 1), (None, "es", 1.0, 1)]
    said = spark.createDataFrame(rows, "row_id long, country_code string, confidence double, ordinal int")
    assert [(r["row_id"], r["country_code"]) for r in impute.clean_predictions(said).collect()] == [(1, "DE")]


def test_vector_cache(spark, tmp_path):
    rows = spark.createDataFrame([("I1", "Leeds", "GB"), ("I2", "Lyon", None)], "id string, display_name string, country_code string")
    cache = str(tmp_path / "v")
    assert {r["id"]: r["vector"] for r in extract.cached_vectors(rows, services.embed, cache).collect()} == {"I1": [5, 1, 2], "I2": [4, 1, 0]}

    def never(texts):
        raise AssertionError(texts)

    assert extract.cached_vectors(rows, never, cache).count() == 2
    changed = rows.withColumn("display_name", F.lit("x"))
    assert {tuple(r["vector"]) for r in extract.cached_vectors(changed, services.embed, cache).collect()} == {(1, 1, 0)}


def test_gate(spark):
    works = spark.createDataFrame([("https://doi.org/10.1234/A", "A: Title")], "doi string, title string")
    assert gate.enforce_anchors(works, ["doi:10.1234/a", "a title", " "]).filter("found").count() == 2
    for bad in ([], ["doi:bad_doi", "a title"], ["missing title"], ["!!!"]):
        with pytest.raises(gate.Rejected):
            gate.enforce_anchors(works, bad)
    with pytest.raises(gate.Rejected):
        gate.checked_query("a or b")
    assert gate.split_topics(["T10020", "t10020", " T10020"]) == (["T10020"], ["t10020", " T10020"])


def test_reports(spark, tmp_path):
    tables = tables_of(spark, services.WORKS)
    lines = report.health_rows(tables).orderBy("at").collect()
    assert [(r["metric"].strip(), r["count"], r["share"]) for r in lines[:2]] == [("Papers", "7", "100.0%"), ("Years", "2001 – 2007", "")]
    assert {r["metric"].strip(): r["count"] for r in lines}["with a row to impute"] == "4" and len(lines) == 23
    (tmp_path / "d.txt").write_text("see 10.1/1.\n(10.1/4)\n10.1/1\n10.1/77")
    dois = readers.doi_list(spark, str(tmp_path / "d.txt")).withColumn("key", F.lower("doi"))
    works = spark.createDataFrame([(json.dumps(w), "", k) for k, w in enumerate(services.WORKS)], "value string, _file string, _line long")
    works = readers.parsed_works(works).select(F.regexp_replace("doi", "https://doi.org/", "").alias("key"), "topics")
    found = report.missing_topic_table(works, dois, spark.createDataFrame([("T10002",)], "topic_id string"))
    assert found.columns == ["Topic ID", "Topic", "Subfield", "Field", "Domain", "Frequency", "Coverage %", "Importance", "Status", "Example DOI"]
    assert [r["Topic ID"] for r in found.collect()] == ["T10001"] and found.first()["Example DOI"] == "10.1/1" and found.first()["Frequency"] == 2
    table = report.keyword_table(spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.9)], "term string, score double"))
    assert [tuple(r) for r in table.orderBy("rank").collect()] == [(1, "c", 0.9), (2, "a", 0.5), (3, "b", 0.5)]
    for form, want in (("txt", "c\na\nb\n"), ("csv", "rank,term,score\n1,c,0.900000\n2,a,0.500000\n3,b,0.500000\n")):
        report.write_keywords(table, str(tmp_path / form), form)
        assert (tmp_path / form).read_text() == want
    with pytest.raises(FileExistsError):
        report.write_keywords(table, str(tmp_path / "txt"), "txt")
    many = spark.range(60).select(F.col("id").cast("string").alias("topic_id"), F.lit(1).alias("paper_count"))
    assert [report.shown_topics(many, d, f)[0] for d, f in ((False, False), (True, False), (False, True))] == ["screen", "file", "file"]
    assert report.shown_topics(many)[1].count() == 20
    assert report.sample_table(tables["papers"]).columns[-2:] == ["relevance", "rationale"] and len(report.sample_table(tables["papers"]).columns) == 14


def test_settings(tmp_path):
    assert len(settings.write_templates(str(tmp_path))) == 4 and settings.write_templates(str(tmp_path)) == []
    assert settings.load(str(tmp_path / "collection.yml")) == settings.DEFAULTS == settings._plain((tmp_path / "collection.yml").read_text())
    assert settings.api_keys({"key": "a", "key10": "c", "key2": "b", "key3": "a"}) == ["a", "b", "c"] and settings.api_keys({"keys": ["x"]}) == ["x"]


def test_commands(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.chdir(tmp_path)

    def at(name):
        return str(tmp_path / name)

    (tmp_path / "w.jsonl").write_text("\n".join(json.dumps(w | {"type": "article", "publication_date": "2010-01-01"}) for w in services.WORKS))
    assert cli.main(["init"]) == 0
    (tmp_path / "config/keywords.txt").write_text("# note\nknown")
    (tmp_path / "config/topics.txt").write_text("T10001\nbad\n")
    (tmp_path / "config/anchor.txt").write_text("10.1234/x\n")
    assert cli.main(["convert-to-db", "--db", at("db"), "--input", at("w.jsonl")]) == 0
    assert cli.main(["validate", "--no-api"]) == 1 and "malformed topic 'bad'" in capsys.readouterr().out
    assert cli.main(["search", "--db", at("db")]) == 1 and "7 papers\nmissing: 10.1234/x" in capsys.readouterr().out
    (tmp_path / "config/anchor.txt").write_text("Known: 1\n")
    assert cli.main(["search-filtered", "--db", at("db")]) == 0 and "3 papers" in capsys.readouterr().out
    assert cli.main(["check-anchor", "--db", at("db")]) == 0
    assert cli.main(["get-topics", "--db", at("db"), "--output", at("topics")]) == 0
    (tmp_path / "dois.txt").write_text("10.1/1")
    assert cli.main(["topic-search", "--output", at("missing"), "--doi-file", at("dois.txt"), "--input", at("w.jsonl")]) == 0
    assert cli.main(["download", "--client", "services:fetch", "--output", at("got")]) == 0
    (tmp_path / "s.csv").write_text("Accession Number,DOI,Article Title\nWOS:8,10.8/8,New\n")
    assert cli.main(["import-wos-csv", at("s.csv"), "--db", at("db"), "--output", at("db2"), "--client", "services:fetch"]) == 0
    assert cli.main(["impute-all", "--db", at("db"), "--output", at("db3"), "--catalog", "services:fetch", "--crossref", "services:crossref", "--model", "services:complete"]) == 0
    assert spark.read.parquet(str(tmp_path / "db3/country_imputation_audit")).count() > 0
    capsys.readouterr()
    named = ["impute-llm", "--db", at("db"), "--model", "services:complete", "--embed", "services:embed", "--vector-cache", at("vectors"), "--batch-size", "3"]
    assert cli.main([*named, "--output", at("none"), "--dry-run"]) == 0 and not (tmp_path / "none").exists()
    said = capsys.readouterr().out
    assert "stage 1: rows" in said and "table contributions: rows 7" in said
    assert cli.main([*named, "--output", at("none"), "--dry-run", "--min-confidence", "0.99"]) == 0
    assert "stage 1: rows 0" in capsys.readouterr().out
    (tmp_path / "x").mkdir()
    (tmp_path / "x/Japan.xlsx").write_bytes(book([HEADER, ["WOS:3", "10.1/3", "Known 3", 2020, 1]]))
    assert cli.main(["import-wos", "--db", at("db"), "--dir", at("x"), "--output", at("db4")]) == 0
    assert spark.read.parquet(str(tmp_path / "db4/papers")).filter("from_wos and is_top_1_percent").count() == 1
    (tmp_path / "b.json").write_text(json.dumps({"1_core_technology": ["laser"]}))
    assert cli.main(["build-categorized-query", "b.json", "--output", "q.txt"]) == 0 and "(((laser)))" in (tmp_path / "q.txt").read_text()
    assert cli.main(["sample", "--db", at("db"), "--size", "3", "--output", at("sample")]) == 0
