"""What queries move: read from their plans."""

from pyspark.sql import functions as F

from colophon import queries
from colophon.operators import keywords


def exchanges(frame) -> int:
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_abstract_rebuild_moves_texts_once(spark, tmp_path):
    """Whole texts are dealt by document; their words stay where they are."""
    rows = [(1, "a b  a\tc a"), (2, ""), (3, None), (4, "  x ")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.QUERIES["abstract_rebuild"](spark, str(tmp_path))
    assert exchanges(found) == 1
    assert dict(map(tuple, found.collect())) == {1: "a b a c a", 2: "", 3: "", 4: "x"}


def test_terms_are_not_kept(spark, monkeypatch):
    """Texts move by document, all terms once by term, those that stay by document and then, added up, by term; nothing is stored."""
    docs = spark.createDataFrame([(1, "red fox red fox"), (2, "red fox runs"), (3, "")], "id long, text string")
    monkeypatch.setattr(type(docs), "checkpoint", None)
    found = keywords.mean_tfidf(docs, 2, 2)
    assert exchanges(found) == 4
    assert [tuple(r) for r in found.select("term", F.round("score", 6)).collect()] == [("red fox", 0.666667)]


def test_vectors_are_compared_in_small_parts(spark, monkeypatch):
    """However many rows a batch has, a part of them meets the queries at once, and the nearest are the same."""
    from colophon.operators import matching

    rows = [(k, [float(k % 7), float(k % 11), 1.0]) for k in range(60)]
    base = spark.createDataFrame(rows, "id long, vector array<double>")

    def found():
        return sorted(map(tuple, matching.nearest_vectors(base.filter("id % 20 = 0"), base, 3, None, same=False).collect()))

    whole = found()
    assert len(whole) == 9 and matching.COMPARED <= 1024
    monkeypatch.setattr(matching, "COMPARED", 4)
    assert found() == whole


def test_loader_keeps_what_its_tables_need(spark, monkeypatch):
    """Records are never kept or moved whole; counts keep nothing; repeated papers, authors without institutions and broken records as before."""
    import duckdb

    from colophon.operators import ingest

    held = []
    frame = type(spark.range(1))
    monkeypatch.setattr(ingest, "kept", lambda df, kept=ingest.kept: held.append(df.columns) or kept(df))
    monkeypatch.setattr(frame, "checkpoint", None)
    connection = duckdb.connect()
    for t in ("orders", "lineitem"):
        connection.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    for name, want in {
        "load_statistics": [],
        "load_works": [[*ingest.CONTRIBUTION, "_part", "_at"]],
        "load_dimensions": [["paper_id", "_file", "_line", "author_no", "inst_no", "author_id", "institution_id", "country_code", "_author", "_orcid", "_institution", "_type", "_ror"]],
        "load_papers": [["_key", "_file", "_line", "_paper"]],
    }.items():
        held.clear()
        found = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
        assert held == want
        rows = connection.execute(queries.ORACLE_SQL[name])
        columns = [d[0] for d in rows.description]
        assert sorted(map(str, map(tuple, found.select(*columns).collect()))) == sorted(map(str, rows.fetchall()))


def test_first_values_send_a_row_for_each_key(spark):
    from colophon.operators import ingest

    rows = spark.createDataFrame([("a", 2, "x", None), ("a", 1, None, "y"), ("b", 3, "z", "z")], "k string, at int, v string, w string")
    found = ingest.first_values(rows, "k", ["v", "w"], ["at"])
    assert sorted(map(tuple, found.collect())) == [("a", None, "y"), ("b", "z", "z")]
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "partial_min_by" in plan


def test_affiliations_of_odd_records(spark):
    """Null authorships, authors and institutions, ids that are null or end with a slash."""
    from colophon.operators import ingest

    inst = "struct<id: string, display_name: string, country_code: string, type: string, ror: string>"
    author = f"struct<author: struct<id: string, display_name: string, orcid: string>, raw_author_name: string, author_position: string, is_corresponding: boolean, countries: array<string>, raw_affiliation_strings: array<string>, institutions: array<{inst}>>"
    a = (("u/A1", "Ann", None), None, "first", True, ["FR"], [" ", "Lab"], None)
    b = (None, "Bob", None, None, None, ["R0", "R1", "R2"], [("u/I1", "I", "DE", None, None), (None, "N", "DE", None, None), None, ("u/", "J", None, None, None)])
    c = (None, None, None, None, [], [], [(None, "N", "DE", None, None)])
    frame = spark.createDataFrame([(1, [a, None, b, c]), (2, []), (3, None)], f"k int, authorships array<{author}>")
    rows = frame.select("k", F.inline(ingest.affiliations(F.col("authorships"), {"author_id", "institution_id", "country_code", "author_name", "raw_affiliation_string"})))
    got = sorted(map(tuple, rows.collect()))
    assert got == [
        (1, 0, 0, "A1", None, "FR", "Ann", "Lab"),
        (1, 1, 0, None, None, None, None, None),
        (1, 2, 0, None, "I1", "DE", "Bob", "R0"),
        (1, 2, 3, None, None, None, "Bob", None),
    ]


def test_terms_move_together(spark, monkeypatch):
    """Terms of many documents move as one row for each part, with the counts of single terms; so do those that stay."""
    texts = ["red fox red fox runs", "red fox", "", None, "one", "a1 b_c blue-ish hen the the the the"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1)
    want = sorted(map(tuple, keywords.terms(docs, 2, 3).collect()))
    for most in (1, 1 << 20):
        monkeypatch.setattr(keywords, "MOVED", most)
        dealt = keywords.dealt_terms(docs, 2, 3, [], 2)
        lists = F.arrays_zip(F.col("ids").alias("id"), F.split("terms", "\n").alias("term"), F.col("tfs").alias("tf"))
        rows = dealt.select("part", F.inline(lists)).collect()
        assert sorted((r["id"], r["term"], r["tf"]) for r in rows) == want
        heads = {(" ".join(r["term"].split()[:2]), r["part"]) for r in rows}
        assert len(heads) == len(dict(heads))
        assert dealt.count() <= 2 or most == 1
    counts = spark.createDataFrame([(k // 5, k, f"t {k}", 1, k) for k in range(10)], "part int, id int, term string, tf int, df int").coalesce(1)
    found = sorted(map(tuple, keywords.together(counts).collect()))
    assert [(r[0], r[1], r[2].split("\n"), r[4]) for r in found] == [(p, [*range(a, a + 5)], [f"t {k}" for k in range(a, a + 5)], [*range(a, a + 5)]) for p, a in ((0, 0), (1, 5))]
