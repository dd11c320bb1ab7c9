import json

import pytest
from pyspark.sql import functions as F

from colophon import schemas
from colophon.operators import coverage, enrich, impute, ingest, keywords, matching, overlap, sampling, topics, wos
from colophon.sources import paged, readers
from colophon.streaming.ingest import ingest_stream


def work(n, authorships=(), **more):
    return {"id": f"https://x/W{n}", "title": f"T{n}", "authorships": list(authorships)} | more


def load(spark, tmp_path, records, present=None, name="works"):
    path = tmp_path / f"{name}.jsonl"
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))
    records = readers.works(spark, str(path))
    return ingest.load(records, present), readers.load_counts(records).first()


AUTHOR = {"author": {"id": "https://x/A1", "display_name": "Ann", "orcid": None}, "raw_affiliation_strings": ["", "Oxford, UK"]}
LISTED = {
    "author": {"id": "https://x/A2", "display_name": "Bob"},
    "institutions": [{"id": "https://x/I1", "display_name": "MIT", "country_code": "US"}, {"id": "https://x/I2", "display_name": "ETH", "country_code": "CH"}],
    "raw_affiliation_strings": ["MIT"],
}
NO_IDS = {"author": {"id": "https://x/A3", "display_name": "Cyd"}, "institutions": [{"display_name": "nameless"}]}


def test_load(spark, tmp_path):
    records = [work(1, [AUTHOR, LISTED]), "", "{broken", work(1, [AUTHOR]), work(2, [NO_IDS], title=None, countries_distinct_count=2)]
    tables, counts = load(spark, tmp_path, records)
    assert tuple(counts) == (4, 1)
    papers = {r["id"]: r for r in tables["papers"].collect()}
    assert set(papers) == {"W1", "W2"} and papers["W2"]["title"] == "Untitled"
    assert papers["W2"]["is_international"] and not papers["W1"]["is_international"]
    rows = tables["contributions"].orderBy("row_id").collect()
    assert [(r["row_id"], r["author_id"], r["institution_id"], r["raw_affiliation_string"]) for r in rows] == [
        (1, "A1", None, "Oxford, UK"),
        (2, "A2", "I1", "MIT"),
        (3, "A2", "I2", None),
    ]
    assert sorted(r["country_code"] for r in tables["countries"].collect()) == ["CH", "US"]
    again, _ = load(spark, tmp_path, [work(1, [NO_IDS]), work(3, [AUTHOR])], tables, "more")
    assert again["papers"].count() == 3
    assert again["contributions"].agg(F.max("row_id")).first()[0] == 4
    report = coverage.health_report(tables).first()
    assert (report["papers"], report["orphans"], report["zero_total"]) == (2, 1, 1)
    assert [f.name for f in schemas.empty_table(spark, "papers").schema] == tables["papers"].columns


def test_partial_buckets(spark):
    rows = [(1, "I"), (1, None), (2, None), (3, "I")] + [(4, None)] * 7 + [(4, "I")]
    frame = spark.createDataFrame(rows, "paper_id int, institution_id string")
    found = coverage.partial_buckets(frame, "paper_id", F.col("institution_id").isNull()).collect()
    assert sorted(map(tuple, found)) == [(1, 1), (5, 1)]


def test_load_makes_the_tables_asked_for(spark, tmp_path, monkeypatch):
    """Tables that are not asked for cost no rows: papers need no contributions, authors no numbers."""
    (tmp_path / "works.json").write_text(json.dumps(work(1, [AUTHOR])) + "\n")
    works = readers.works(spark, str(tmp_path / "works.json"))
    whole = ingest.load(works)
    assert tuple(whole) == ingest.TABLES
    monkeypatch.setattr(ingest, "number_rows", None)
    for only in (("papers",), ("authors", "institutions"), ()):
        made = ingest.load(works, only=only)
        assert tuple(made) == only
        for name in only:
            assert made[name].columns == whole[name].columns and made[name].collect() == whole[name].collect()
    monkeypatch.setattr(ingest, "affiliations", None)
    assert ingest.load(works, only=("papers",))["papers"].count() == 1


def test_records_are_parsed_once(spark, tmp_path):
    """Conditions on columns of records stay above the parse; below it each would parse the record anew."""
    (tmp_path / "works.json").write_text("\n".join([json.dumps(work(1, [AUTHOR])), " ", "{broken", json.dumps(work(2, []))]))
    works = readers.works(spark, str(tmp_path / "works.json"))
    found = works.filter("id is not null and _corrupt_record is null").select("id", "title", "authorships")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert works.count() == 3 and sorted(r["id"].rsplit("/", 1)[-1] for r in found.collect()) == ["W1", "W2"]


def test_report_needs_no_numbers(spark, tmp_path, monkeypatch):
    (tmp_path / "works.json").write_text("\n".join(json.dumps(w) for w in (work(1, [AUTHOR, LISTED]), work(2, [NO_IDS]), work(3, []))))
    works = readers.works(spark, str(tmp_path / "works.json"))
    whole = ingest.load(works)
    monkeypatch.setattr(ingest, "number_rows", None)
    made = ingest.load(works, numbered=False)
    assert tuple(made) == ingest.TABLES and made["contributions"].columns == whole["contributions"].columns[1:]
    for name in ("contributions", "countries"):
        columns = made[name].columns
        assert sorted(map(str, made[name].collect())) == sorted(map(str, whole[name].select(*columns).collect()))
    report = coverage.health_report(made)
    assert report.collect() == coverage.health_report(whole).collect()
    assert "HashedRelation" not in report._jdf.queryExecution().sparkPlan().toString() and "SortMergeJoin" in report._jdf.queryExecution().sparkPlan().toString()
    with pytest.raises(ValueError):
        ingest.load(works, whole, numbered=False)


def test_fuzzy_scores_and_guards(spark):
    assert matching.token_sort_ratio("b a", "a b") == 100.0
    assert matching.token_sort_ratio("abcd", "abxd") == pytest.approx(75.0)
    long = "a survey of quantum sensing with diamond defects"
    base = [(1, long, 2020), (2, long.replace("diamond", "diamonds"), 2020), (3, "short title", 2020), (4, long, 2010), (5, "something else entirely about lasers and optics", 2020)]
    titles = spark.createDataFrame(base, "id long, title string, year int")
    asked = spark.createDataFrame([(10, "with diamond defects a survey of quantum sensing", 2021), (11, "short title", 2020), (12, long + "s", None)], "id long, title string, year int")
    found = {r["query_id"]: (r["base_id"], round(r["score"])) for r in matching.fuzzy_match(asked, titles).collect()}
    assert found == {10: (1, 100), 12: (1, 99)}


def test_fuzzy_candidates_lose_nothing(spark):
    import random

    rng = random.Random(8)
    words = ["alpha", "beta", "gamma", "delta", "sensor", "laser", "of", "the"]
    rows = []
    for k in range(40):
        text = list(" ".join(rng.choice(words) for _ in range(8)))
        rows.append((2 * k, "".join(text), None))
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = rng.choice("xyz")
        rows.append((2 * k + 1, "".join(text), None))
    frame = spark.createDataFrame(rows, "id long, title string, year int")
    found = {(r["query_id"], r["base_id"]) for r in matching.fuzzy_candidates(frame, frame, 0.9).collect()}
    want = {
        (i, j)
        for i, a, _ in rows
        for j, b, _ in rows
        if len(a) >= 30 and matching.token_sort_ratio(a, b) >= 90 and min(len(a), len(b)) >= 0.6 * max(len(a), len(b))
    }
    assert found == want


def test_fuzzy_candidates_at_the_threshold(spark):
    asked = "abcdefghijklmnopqrstuvwxyz0123456789"
    base = "".join(asked[k : k + 2] + "_" + asked[k + 2 : k + 4] for k in range(0, 32, 4)) + asked[32:]
    q, b = (spark.createDataFrame([(k, t, None)], "id long, title string, year int") for k, t in ((1, asked), (2, base)))
    assert [tuple(r)[-1] for r in matching.fuzzy_candidates(q, b, 0.9).select("score").collect()] == [90.0]
    assert [tuple(r) for r in matching.fuzzy_texts(q, b, 0.9).collect()] == [(1, 2, 90.0)]


@pytest.mark.parametrize("threshold", [0.95, 0.8, 0.6])
def test_fuzzy_candidates_of_repeated_and_short_titles(spark, threshold):
    """Equal titles of many rows, white space, null, titles of a few characters, other scripts."""
    import random

    rng = random.Random(3)
    rows = [(k, "the same title that a third of all rows have in common", None) for k in range(40)]
    rows += [(100, None, 1), (101, "   ", 1), (102, "a", 1), (103, "a b", 1), (104, "b  a", 1), (105, "", 1)]
    for k in range(30):
        words = ["".join(rng.choice("abcé中😀") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 9))]
        rows.append((200 + 2 * k, " ".join(words), k))
        words[rng.randrange(len(words))] += rng.choice("xy")
        rng.shuffle(words)
        rows.append((201 + 2 * k, "  ".join(words), k))
    frame = spark.createDataFrame(rows, "id long, title string, year int")
    found = matching.fuzzy_candidates(frame.filter("id % 2 = 0"), frame, threshold, least_length=1)
    got = {(r["query_id"], r["base_id"]): round(r["score"], 9) for r in found.collect()}
    want = {}
    for i, a, _ in rows:
        for j, b, _ in rows:
            if i % 2 == 0 and a and b and a.strip() and b.strip() and min(len(a), len(b)) >= 0.6 * max(len(a), len(b)):
                score = matching.token_sort_ratio(a, b)
                if score >= 100 * threshold - 1e-9:
                    want[i, j] = round(score, 9)
    assert got == want


@pytest.mark.parametrize("common", [16, 1e-6])
def test_fuzzy_candidates_of_titles_that_share_most(spark, monkeypatch, common):
    """Titles of one form: common grams are no keys, so few rows meet, and no pair is lost; the same if nothing counts as common."""
    monkeypatch.setattr(matching, "COMMON", common)
    names = ["large ring", "hot bolt", "blue plate", "cold nut"]
    rows = [(k, f"on the long term behaviour of {names[k % 4]} under load {k}", None) for k in range(120)]
    rows += [(200 + k, f"something of its own {k * 7919} and {k * 104729} alone", None) for k in range(40)]
    frame = spark.createDataFrame(rows, "id long, title string, year int")
    found = {(r["query_id"], r["base_id"]): round(r["score"], 9) for r in matching.fuzzy_candidates(frame.filter("id % 3 = 0"), frame).collect()}
    scores = {(i, j): matching.token_sort_ratio(a, b) for i, a, _ in rows for j, b, _ in rows if i % 3 == 0}
    assert found == {pair: round(s, 9) for pair, s in scores.items() if s >= 95 - 1e-9}
    texts = frame.select(F.col("id").alias("number"), matching.sorted_text(F.col("title")).alias("text"))
    counts = matching.gram_counts(texts, 6)
    filed = matching.rarest_grams(texts, 6, 0.95, counts, len(rows) / common)
    met = filed.filter("token is not null").groupBy("token").count().agg(F.sum(F.col("count") ** 2)).first()[0]
    assert (met < len(rows) ** 2) == (common == 16)


def test_letter_sketches_never_differ_by_more_than_the_edits():
    import random

    rng = random.Random(8)
    for _ in range(300):
        a = "".join(rng.choice("abcdefgé中😀 ") for _ in range(rng.randint(0, 80)))
        b = "".join(c for c in a if rng.random() < 0.9) + "".join(rng.choice("abx") for _ in range(rng.randint(0, 9)))
        differ = sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(matching.letter_sketch(a), matching.letter_sketch(b)))
        assert differ <= len(a) + len(b) - 2 * matching.common_subsequence(a, b)
    assert matching.letter_sketch("abc") == matching.letter_sketch("cab") != matching.letter_sketch("abd")


@pytest.mark.parametrize("common", [16, 1e6])
def test_fuzzy_candidates_among_themselves(spark, monkeypatch, common):
    """Without a base every row is asked and answers; few pairs get as far as their score."""
    monkeypatch.setattr(matching, "COMMON", common)
    rows = [(k, f"on the long term behaviour of part {k * 37 % 90} under load {k}", k) for k in range(90)]
    rows += [(100 + k, t, k) for k, t in enumerate([None, "", " " * 40, "short", rows[3][1], rows[3][1] + "  ", "of part  a b", "b a part of"])]
    frame = spark.createDataFrame(rows, "id long, title string, year int")
    found = matching.fuzzy_candidates(frame, None)
    got = sorted((r["query_id"], r["base_id"], round(r["score"], 9)) for r in found.collect())
    both = matching.fuzzy_candidates(frame, frame)
    assert got == sorted((r["query_id"], r["base_id"], round(r["score"], 9)) for r in both.collect())
    want = {(i, j) for i, a, _ in rows for j, b, _ in rows if a and b and len(a) >= 30 and b.strip() and a.strip() and matching.token_sort_ratio(a, b) >= 95 - 1e-9}
    assert {(i, j) for i, j, _ in got} == want and len(got) == len(want) > 97 and {c for c in found.columns} == {c for c in both.columns}


def test_fuzzy_clients_asks_every_client(spark, tmp_path):
    """Clients whose number is no multiple of 50 are asked too."""
    from colophon import queries

    rows = [(k, f"name of client {n}", f"client{n}@mail.example.org", "harbour town") for k, n in ((1, "one"), (2, "ones"), (3, "seventeen"), (50, "one"))]
    spark.createDataFrame(rows, "client_id long, name string, email string, city string").write.parquet(str(tmp_path / "clients.parquet"))
    found = {(r["query_id"], r["base_id"]) for r in queries.QUERIES["fuzzy_clients"](spark, str(tmp_path)).collect()}
    assert found == {(i, j) for i in (1, 2, 50) for j in (1, 2, 50) if i != j}


def test_common_within_holds_the_places_that_edits_allow():
    """Equal to the whole comparison on texts of unequal lengths, with steps shorter than them; a band as wide as the edits, not twice."""
    import random

    rng = random.Random(5)
    for k in range(400):
        a = "".join(rng.choice("abcdef") for _ in range(rng.randint(1, 90)))
        b = "".join(c for c in a if rng.random() < 0.9) + "".join(rng.choice("abcx") for _ in range(rng.randint(0, 12)))
        b = b[k % 7 :] + b[: k % 7]
        want = matching.common_subsequence(a, b)
        need = len(a) + len(b) - 2 * want
        for edits in {need - 1, need, need + 1, need + 7}:
            for step in (1, 5, 256):
                got = matching.common_within(matching.letter_places(a), len(a), b, edits, step)
                assert got == (want if edits >= need else None)

    class Places(dict):
        def get(self, c, default=0):
            return Held(super().get(c, default))

    widths = []

    class Held(int):
        def __rshift__(self, k):
            return Held(int(self) >> k)

        def __and__(self, full):
            widths.append(full.bit_length())
            return int(self) & full

    text = "abcdefghij" * 40
    assert matching.common_within(Places(matching.letter_places(text)), 400, text, 80, 10) == 400
    assert max(widths) <= 80 + 2 * 10


def test_texts_of_fuzzy_joins_are_never_broadcast(spark, monkeypatch, tmp_path):
    """Sizes guessed from files say that texts are small enough to go through the driver, whatever their number."""
    plans = []

    def planned(df):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return df

    monkeypatch.setattr(matching, "fixed", lambda df, kept=matching.fixed: kept(planned(df)))
    rows = [(k, f"a title of some length with number {k} in it", None) for k in range(60)]
    spark.createDataFrame(rows, "id long, title string, year int").write.parquet(str(tmp_path / "titles"))
    frame = spark.read.parquet(str(tmp_path / "titles"))
    for find in (matching.fuzzy_candidates, matching.fuzzy_texts):
        assert planned(find(frame.filter("id % 2 = 0"), frame, 0.95)).count() > 30
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)


def test_fuzzy_texts_equal_brute_force(spark):
    import random

    rng = random.Random(11)
    words = ["alpha", "beta", "gämma", "delta", "sensor", "laser", "of", "the", "x1"]
    rows = []
    for k in range(12):
        text = [rng.choice(words) + rng.choice(["", "s", "ed"]) for _ in range(rng.choice([1, 6, 30, 300]))]
        for _ in range(4):
            rows.append((len(rows), " ".join(text)))
            text = [w if rng.random() < 0.9 else w[1:] + rng.choice("xyz") for w in text]
            rng.shuffle(text)
    rows.append((len(rows), None))
    frame = spark.createDataFrame(rows, "id long, title string")
    for block in (1 << 22, 100):
        found = {(r["query_id"], r["base_id"]): r["score"] for r in matching.fuzzy_texts(frame.filter("id % 2 = 0"), frame, 0.9, block_chars=block).collect()}
        want = {
            (i, j): matching.token_sort_ratio(a, b)
            for i, a in rows
            for j, b in rows
            if i % 2 == 0 and a and b and len(a) >= 30 and matching.token_sort_ratio(a, b) >= 90 and min(len(a), len(b)) >= 0.6 * max(len(a), len(b))
        }
        assert found == want and any(i != j for i, j in want)


def test_fuzzy_title_compares_whole_texts(spark, tmp_path):
    from colophon import queries

    opening = "licensed under the terms that the first line of this file states in full and at length "
    one, two = ("".join(f"{a}{k}{b} " for k in range(60)) for a, b in (("red", "fox"), ("blue", "hen")))
    rows = [(0, opening + one), (1, opening + two), (2, one + "and more"), (3, one), (50, None), (4, None), (100, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.QUERIES["fuzzy_title"](spark, str(tmp_path)).collect()
    assert {(r["query_id"], r["base_id"]) for r in found} == {(0, 2), (0, 3)}


def test_author_alignment(spark):
    targets = spark.createDataFrame([("p", 1, "o1"), ("p", 2, None), ("p", 3, None), ("q", 4, None), ("r", 5, None)], "paper_id string, row_id int, orcid string")
    others = spark.createDataFrame([("p", 0, None), ("p", 1, "o1"), ("p", 2, ""), ("q", 0, None), ("q", 1, None)], "paper_id string, pos int, orcid string")
    found = sorted((r["row_id"], r["other_pos"], r["method"]) for r in matching.align_authors(targets, others).collect())
    assert found == [(1, 1, "orcid"), (2, 0, "position"), (3, 2, "position"), (4, None, "author_count_mismatch"), (5, None, "unmatched")]


def test_sheet_records_and_overlay(spark):
    sheet = spark.createDataFrame(
        [("WOS:1", "HTTPS://doi.org/10.1/Foo", "A", "2020", "42", "1", 1, "US"), ("WOS:2", None, "New Title", "early-access", None, "", 2, "CN"), ("WOS:3", None, "new title!", "2021", None, None, 3, "US")],
        "`Accession Number` string, DOI string, `Article Title` string, `Publication Date` string, `Times Cited` string, `Top 1%` string, ordinal int, country_code string",
    )
    rows = wos.records(sheet)
    got = {r["ordinal"]: r for r in rows.collect()}
    assert got[1]["doi"] == "10.1/foo" and got[1]["year"] == 2020 and got[1]["top_1"] and got[2]["year"] is None and not got[2]["top_1"]
    papers = schemas.evolve(spark.createDataFrame([("W1", "10.1/foo", "Old", 2019)], "id string, doi string, title string, publication_year int"), schemas.LATER_COLUMNS["papers"])
    papers = papers.withColumns({c: F.lit(False) for c in ("is_top_1_percent", "is_top_10_percent")})
    lines = spark.createDataFrame([], "row_id long, paper_id string, country_code string, source string")
    merged, marks = wos.overlay(papers, lines, rows, fuzzy=False)
    out = {r["id"]: r for r in merged.collect()}
    assert set(out) == {"W1", "WOS_2"} and out["W1"]["from_wos"] and out["W1"]["wos_accession_number"] == "WOS:1"
    assert marks.count() == 3


def test_imputation_stages(spark):
    lines = spark.createDataFrame(
        [(1, "p", None, None, "MIT, Cambridge, MA, USA"), (2, "p", None, None, "Joint center between USA and China"), (3, "q", "I1", None, "Wuhan University")],
        "row_id long, paper_id string, institution_id string, country_code string, raw_affiliation_string string",
    )
    third, log = impute.stage_3(lines)
    assert {r["row_id"]: r["country_code"] for r in third.collect()} == {1: "US", 2: None, 3: None} and log.count() == 1
    places = spark.createDataFrame([("I1", "Wuhan University, China", None)], "id string, display_name string, country_code string")
    second, known, _ = impute.stage_2(lines, places)
    assert second.filter("row_id = 3").first()["country_code"] == "CN" == known.first()["country_code"]
    said = spark.createDataFrame([(1, "MIT", "us", 0.9), (1, "Other", "us", 0.95), (2, "Low", "us", 0.1)], "row_id long, institution_name string, country_code string, confidence double")
    first, made, audit = impute.stage_1(lines, places.withColumn("is_synthetic", F.lit(False)), said.limit(1))
    assert first.filter("row_id = 1").first()["institution_id"].startswith("IMP_") and made.count() == 2 and audit.count() == 1
    assert impute.hong_kong_as_china(spark.createDataFrame([(" hk ",), ("CN",)], "country_code string")).filter("country_code <> 'CN'").count() == 0
    with pytest.raises(ValueError):
        impute.stages("1,4")
    asked = impute.predict(lines.select("row_id"), lambda rows: [{"row_id": r["row_id"], "country_code": "DE"} for r in rows[:1]], "row_id long, country_code string", 2)
    assert asked.count() == 3


def test_enrichment(spark):
    lines = spark.createDataFrame([(1, "p", "A1", None, None), (2, "p", "A2", None, " ")], "row_id long, paper_id string, author_id string, institution_id string, raw_affiliation_string string")
    authors = spark.createDataFrame([("A2", "https://orcid.org/0-1")], "id string, orcid string")
    payload = {"message": {"author": [{"ORCID": "http://orcid.org/0-1", "affiliation": [{"name": "X"}, {"name": "Y"}]}, {"affiliation": [{"name": "Z"}]}]}}
    out, _ = enrich.from_crossref(lines, authors, spark.createDataFrame([("p", json.dumps(payload))], "paper_id string, payload string"))
    assert {r["row_id"]: r["raw_affiliation_string"] for r in out.collect()} == {1: "Z", 2: "X | Y"}
    said = {"authors": [{"affiliations": ["B", ""]}, {"affiliations": []}]}
    out, _ = enrich.from_scholar(lines, spark.createDataFrame([("p", json.dumps(said))], "paper_id string, payload string"))
    assert {r["row_id"]: r["raw_affiliation_string"] for r in out.collect()} == {1: "B", 2: None}


def test_tfidf_by_hand(spark):
    import math

    docs = spark.createDataFrame([(1, "red fox red"), (2, "red dog"), (3, "blue dog")], "id int, text string")
    got = {r["term"]: r["score"] for r in keywords.mean_tfidf(docs, 1, 1, 1, 1.0).collect()}
    idf = {t: math.log(4 / (1 + n)) + 1 for t, n in {"red": 2, "dog": 2, "fox": 1, "blue": 1}.items()}
    first = math.hypot(2 * idf["red"], idf["fox"])
    second = math.hypot(idf["red"], idf["dog"])
    assert got["red"] == pytest.approx((2 * idf["red"] / first + idf["red"] / second) / 3)
    flat = keywords.blend(spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, 4.0)], "term string, tfidf_score double, keybert_score double"))
    assert {r["term"]: r["combined_score"] for r in flat.collect()} == {"a": 0.5, "b": 1.0}


def test_tfidf_of_all_documents_equals_brute_force(spark, tmp_path):
    import math
    import random
    import re
    from collections import Counter

    from colophon import queries

    rng = random.Random(6)
    words = ["red", "fox", "état", "naïve", "straße", "don't", "x-ray", "co-é", "mid-", "a1", "b_c", "m²", "dog", "Ünder", "e\u0301a", "the"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(8, 60))) for _ in range(40)] + ["short", None]
    rows = [(i, t, rng.choice(["en", "fr", "de", "es"])) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {r["term"]: r["score"] for r in queries.QUERIES["tfidf_keywords_all"](spark, str(tmp_path)).collect()}

    held = []
    for text in texts:
        if text and len(text) >= 20:
            w = re.findall(r"\b[a-zA-Z][a-zA-Z\-]+\b", text.lower())
            held.append(Counter(" ".join(w[k : k + n]) for n in (2, 3) for k in range(len(w) - n + 1)))
    df = Counter(t for d in held for t in d)
    idf = {t: math.log((1 + len(held)) / (1 + n)) + 1 for t, n in df.items() if 2 <= n <= 0.85 * len(held)}
    score = Counter()
    for d in held:
        x = {t: n * idf[t] for t, n in d.items() if t in idf}
        norm = math.sqrt(sum(v * v for v in x.values()))
        for t, v in x.items():
            score[t] += v / norm / len(held)
    want = sorted(score, key=lambda t: (-score[t], t))[:200]
    assert len(want) == 200 and len({t.count(" ") for t in found}) == 2
    assert sorted(found.values(), reverse=True) == pytest.approx([score[t] for t in want], abs=2e-6)
    assert all(found[t] == pytest.approx(score[t], abs=2e-6) for t in found)


def test_samples_and_topics(spark):
    frame = spark.range(1000).withColumn("s", F.when(F.col("id") < 700, "a").when(F.col("id") < 701, "b").otherwise("c"))
    assert {r["s"]: r["quota"] for r in sampling.quotas(frame, "s", 33).collect()} == {"a": 23, "b": 0, "c": 10}
    picked = sampling.stratified(frame, "s", 33, "id")
    assert picked.count() == 33 and sampling.exact(frame, 5, "id").collect() == sampling.exact(frame.repartition(7), 5, "id").collect()
    assert sampling.reservoir(frame, 5000).count() == 1000
    levels = spark.createDataFrame([(x,) for x in (20.0, 19.9, 10.0, 5.0, 2.0, 1.0, 0.5)], "x double").select(topics.importance(F.col("x"))).collect()
    assert [r[0].split(" ", 1)[1] for r in levels] == ["Critical", "High", "High", "Medium", "Low", "Very Low", "Negligible"]
    text = spark.createDataFrame([("fuel cell and bms",), ("solar cell",), ("energy storage for the grid",), (None,)], "t string")
    assert [r[0]["relevance"] for r in text.select(sampling.relevance(F.col("t"))).collect()] == ["Relevant", "Noise", "Relevant", "Noise"]


def test_overlap(spark):
    ours = spark.createDataFrame([("a",), ("b",)], "key string")
    theirs = spark.createDataFrame([("b",), ("c",)], "key string")
    assert tuple(overlap.report(ours, theirs).first())[:5] == (2, 2, 1, 1, 1)
    rows = spark.createDataFrame([("c", 1), ("c", 2), (None, 3), ("b", 4)], "doi string, n int")
    assert sorted(r["n"] for r in overlap.rows_only_theirs(rows, F.col("doi"), ours).collect()) == [1, 2]
    assert sorted(r["n"] for r in overlap.absent_rows(rows, F.col("doi"), ours).collect()) == [1, 2, 3]


def test_paged_source(spark):
    def fetch(text, cursor, per_page):
        k = 0 if cursor == "*" else int(cursor)
        rows = [{"id": f"{text}{k}"}] if k < 3 else []
        return {"results": rows, "meta": {"next_cursor": str(k + 1), "count": 3}}

    spark.dataSource.register(paged.paged_source(fetch, ["a", "b"]))
    found = sorted(json.loads(r["value"])["id"] for r in spark.read.format("paged_works").load().collect())
    assert found == ["a0", "a1", "a2", "b0", "b1", "b2"] and paged.count(fetch, ["a", "b"]) == 6
    pool = paged.KeyPool(["x", "y"])
    pool.mark("x", "exhausted")
    assert [pool.next(), pool.next()] == ["y", "y"]
    pool.reset()
    assert "x" in {pool.next(), pool.next()} and paged.spacing("a AND b") == 0.0 < paged.spacing(" OR ".join("abcdefgh"))


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("DOI;T\n10.1/x;n/a\n;y\n")
    rows = readers.sniffed(spark, str(tmp_path / "a.csv"))
    assert rows.columns == ["DOI", "T"] and rows.count() == 2
    assert readers.table_csv(spark, str(tmp_path / "a.csv"), sep=";").filter("T is null").count() == 1
    with pytest.raises(ValueError):
        readers.table_csv(spark, str(tmp_path / "a.csv"))
    (tmp_path / "t.xls").write_text("<html><table><tr><td>x</td></tr></table><table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr></table>")
    assert [tuple(r) for r in readers.sniffed(spark, str(tmp_path / "t.xls")).collect()] == [("1", "2")]
    (tmp_path / "d.txt").write_text("see 10.1/a.,\nnothing\n10.1/b\n10.1/a\n")
    assert {r["doi"] for r in readers.doi_list(spark, str(tmp_path / "d.txt")).collect()} == {"10.1/a", "10.1/b"}
    assert readers.kind_of(b"PK\x03\x04") == "excel" and readers.encoding_of("ü".encode("latin-1")) == "windows-1252"


def test_stream_takes_first_writer(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k, text in enumerate(['{"id": 1, "v": 1}\n{"id": 1, "v": 0}', '{"id": 1, "v": 9}\n{"id": 2, "v": 5}']):
        (tmp_path / "in" / f"{k}.json").write_text(text)
        stream = spark.readStream.schema("id int, v int").json(str(tmp_path / "in"))
        ingest_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "id", "v").awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == [(1, 0), (2, 5)]


def test_stream_state_over_restarts(spark, tmp_path):
    """Three deliveries with a restart before each; a batch updates the state of its own new keys alone and never reads the table."""
    (tmp_path / "in").mkdir()
    for k, keys in enumerate([[1, 2, 2, None], [2, 1, 3], [3, 1, 4, 4, 2]]):
        lines = [json.dumps({"id": i, "v": None if n == 1 else 10 * k + n}) for n, i in enumerate(keys)]
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(lines))
        stream = spark.readStream.schema("id int, v int").json(str(tmp_path / "in"))
        query = ingest_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "id", "v")
        query.awaitTermination()
        state = [p["stateOperators"][0] for p in query.recentProgress if p["numInputRows"]]
        assert sum(s["numRowsUpdated"] for s in state) == [2, 1, 1][k]
    found = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    assert found == [(1, 0), (2, 2), (3, 12), (4, 22)]  # each in the delivery that had it first, the least value but null


def test_stream_state_is_asked_without_python(spark, tmp_path):
    """Many keys in a batch: no row goes through Python by itself, whatever the kinds of key and order."""
    from colophon.streaming.ingest import first_rows

    rows = spark.range(3000).selectExpr("concat('k', id % 1000) as id", "if(id < 1000, null, 3000.0 - id) as v", "id as n")
    rows.write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).json(str(tmp_path / "in"))
    plan = first_rows(stream, "id", "v")._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" not in plan and "Deduplicate" in plan
    ingest_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "id", "v").awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r["n"], r["v"]) for r in found) == [(n, 3000.0 - n) for n in range(2000, 3000)]


def test_matched_institutions_and_statistics(spark):
    """The match's country goes before the prediction's; terms, outcomes and the surest predictions."""
    from colophon.operators.runstats import RunStats

    lines = spark.createDataFrame([(k, "p", None, None, "Univ") for k in range(1, 6)], "row_id long, paper_id string, institution_id string, country_code string, raw_affiliation_string string")
    places = spark.createDataFrame([("I1", "Tokyo", "jp", False)], "id string, display_name string, country_code string, is_synthetic boolean")
    said = spark.createDataFrame(
        [(1, "Tokio", None, 0.9), (2, "Far", "fr", 0.85), (3, None, "de", 0.9), (4, None, None, 0.9), (5, "Unsure", "us", 0.5)],
        "row_id long, institution_name string, country_code string, confidence double",
    )
    names = spark.createDataFrame([("I1", [1.0, 0.0], "institution"), ("1", [1.0, 0.5], "prediction"), ("2", [0.0, 1.0], "prediction")], "id string, vector array<double>, kind string")
    stats = RunStats()
    out, made, log = impute.stage_1(lines, places, said, names, stats=stats)
    got = {r["row_id"]: (r["institution_id"], r["country_code"]) for r in out.collect()}
    assert got[1] == ("I1", "JP") and got[2][0].startswith("IMP_") and got[2][1] == "FR" and got[3] == (None, "DE") and got[4] == got[5] == (None, None)
    terms = {r["row_id"]: (r["matched_terms"], r["confidence"]) for r in log.collect()}
    assert terms == {1: ("matched: Tokyo (score=0.89)", 0.9), 2: ("synthetic: Far", 0.85), 3: ("country-only (no institution extracted)", 0.9)}
    assert stats.counts()["stage 1"] == {"rows": 4, "matched": 1, "synthetic": 1, "country_only": 1, "skipped": 1}
    assert made.count() == 2
    second = spark.createDataFrame([("I2", "Nowhere", None, False)], "id string, display_name string, country_code string, is_synthetic boolean")
    rows = spark.createDataFrame([(1, "p", "I2", None, "b"), (2, "q", "I2", None, "a")], lines.schema)
    told = spark.createDataFrame([("I2", "it", "unambiguous", 0.85)], "id string, country_code string, status string, confidence double")
    _, _, log = impute.stage_2(rows, second, told)
    assert [tuple(r)[1:] for r in log.collect()] == [(None, None, "IT", "llm-inferred (status=unambiguous)", "a", "llm", 0.85, "2")]


def test_first_paper_of_a_title_decides(spark):
    """A similar title whose first paper is of another year is refused, though a later paper's year fits."""
    title = "a survey of quantum sensing with diamond defects"
    papers = spark.createDataFrame([("W1", None, title, 1990), ("W2", None, title, 2020)], "id string, doi string, title string, publication_year int")
    sheet = spark.createDataFrame([("WOS:1", title + "s", "2020", "Review", 1), ("WOS:2", title + "s", None, "Article", 2)], "`Accession Number` string, `Article Title` string, `Publication Date` string, `Document Type` string, ordinal int")
    named = wos.with_paper(wos.match(wos.records(sheet), papers))
    assert {r["ordinal"]: (r["paper_id"], r["match_method"]) for r in named.collect()} == {1: ("WOS_1", "new"), 2: ("W1", "title_fuzzy:98")}
    assert [(r["id"], r["type"]) for r in wos.stubs(named).collect()] == [("WOS_1", "Review")]


def test_buckets_that_a_delta_leaves_alone(spark, tmp_path):
    """Files of buckets without a key of the delta stay; keys repeat, are null or new; an empty delta writes nothing."""
    import os

    from colophon.operators import bucketed

    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(f"k{k}", k, None) for k in range(200)] + [(None, 7, "n")], "id string, n int, t string")
    bucketed.create(frame, path, "id", 16)

    def files():
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}

    before = files()
    delta = spark.createDataFrame([("k3", 1, 50), ("k3", 0, 40), ("new", 0, 9), (None, 0, 8)], "id string, place int, n int")
    written = bucketed.upsert(path, frame.schema, delta, "id", "place", {"n": lambda old, new: old + new}, 16)
    after = files()
    assert 2 <= len(written) <= 3 and 16 in written
    kept = {f for f in before if int(f.split("_bucket=")[1].split("/")[0]) not in written}
    assert kept and all(after.get(f) == before[f] for f in kept) and all(int(f.split("_bucket=")[1].split("/")[0]) in written for f in set(after) - kept)
    found = {(r["id"], r["n"]) for r in bucketed.read(spark, path, frame.schema).collect()}
    assert found == {(f"k{k}", k + 40 * (k == 3)) for k in range(200)} | {(None, 7), (None, 8), ("new", 9)}
    assert bucketed.upsert(path, frame.schema, delta.limit(0), "id", "place", {}, 16) == [] and files() == after
