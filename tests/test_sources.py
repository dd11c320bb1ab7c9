"""Conditions that reach a service, and sets of files that are visible whole or not at all."""

import json
import os

import pytest
from pyspark.sql import functions as F

from colophon.sources import paged, record_sets

RECORDS = [
    {"id": f"W{k}", "title": None if k == 5 else f"Title {k}", "type": "article" if k % 2 else "book", "publication_date": f"20{10 + k % 9}-01-01", "primary_topic": {"id": f"https://x/T{k % 25:05}"} if k % 7 else None}
    for k in range(100)
]


def client(log):
    """A service over ``RECORDS`` that notes each request."""

    def fetch(filter_text, cursor, per_page):
        with open(log, "a") as out:
            out.write(filter_text + "\n")
        asked = dict(p.split(":", 1) for p in filter_text.split(",") if p)
        found = [
            r for r in RECORDS
            if ("type" not in asked or r["type"] in asked["type"].split("|"))
            and ("primary_topic.id" not in asked or (r["primary_topic"] or {"id": ""})["id"][-6:] in asked["primary_topic.id"].split("|"))
            and asked.get("from_publication_date", "") <= r["publication_date"] <= asked.get("to_publication_date", "9")
        ]
        at = 0 if cursor == "*" else int(cursor)
        groups = [{"key": t, "key_display_name": t, "count": sum(r["type"] == t for r in found)} for t in ("article", "book")] if at == 0 else []
        return {"results": found[at : at + per_page], "group_by": groups, "meta": {"count": len(found), "next_cursor": str(at + per_page)}}

    return fetch


def test_conditions_reach_the_service(spark, tmp_path):
    log = str(tmp_path / "log")
    works = paged.read_works(spark, client(log), per_page=7)
    topics = [f"T{k:05}" for k in range(12)]
    picked = works.filter(F.col("topic_id").isin(topics) & (F.col("type") == "article") & (F.col("publication_date") >= "2012-01-01") & (F.col("publication_date") <= "2016-12-31") & (F.length("title") > 7))
    found = {r["id"] for r in picked.collect()}
    want = {r["id"] for r in RECORDS if r["primary_topic"] and r["primary_topic"]["id"][-6:] in topics and r["type"] == "article" and "2012" <= r["publication_date"] < "2017" and len(r["title"] or "") > 7}
    assert found == want and want
    asked = set(open(log).read().split())
    dates = "from_publication_date:2012-01-01,to_publication_date:2016-12-31,type:article,primary_topic.id:"
    assert asked == {dates + "|".join(topics[:10]), dates + "|".join(topics[10:])}


def test_what_stays_with_spark(spark, tmp_path):
    log = str(tmp_path / "log")
    works = paged.read_works(spark, client(log), per_page=200)
    assert works.filter("type = 'article' or topic_id = 'T00001'").count() == sum(r["type"] == "article" or (r["primary_topic"] or {}).get("id") == "https://x/T00001" for r in RECORDS)
    assert works.filter("publication_date > '2017-01-01'").count() == sum(r["publication_date"] > "2017-01-01" for r in RECORDS)
    assert works.filter("type in ('article', 'a|b')").count() == 50
    assert works.filter("topic_id in ('T00001', 'T00002') and topic_id in ('T00002', 'T00003')").count() == sum((r["primary_topic"] or {}).get("id") == "https://x/T00002" for r in RECORDS)
    assert works.filter("type is null").count() == 0 and works.filter("topic_id is null").count() == 15


def test_counts_and_groups_do_not_page(spark, tmp_path):
    log = str(tmp_path / "log")
    assert [r["n"] for r in paged.read_works(spark, client(log), form="count", per_page=1).collect()] == [100]
    assert len(open(log).read().split("\n")) == 2
    groups = paged.read_works(spark, client(log), form="groups").collect()
    assert {(r["key"], r["n"]) for r in groups} == {("article", 50), ("book", 50)}


def test_stream_form_follows_the_cursor(spark, tmp_path):
    spark.dataSource.register(paged.paged_source(client(str(tmp_path / "log")), [""], per_page=30))
    stream = spark.readStream.format("paged_works").load()
    query = stream.writeStream.format("json").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"))
    query.awaitTermination()
    for _ in range(5):  # a page a batch
        query = stream.writeStream.format("json").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"))
        query.awaitTermination()
    found = [json.loads(r["value"])["id"] for r in spark.read.json(str(tmp_path / "out")).collect()]
    assert sorted(found) == sorted(r["id"] for r in RECORDS)


ROWS = [(1, "a, \"b\"\nc", 1.5), (2, None, None), (3, "", 0.0), (4, "é\U0001f600", -1.0)]


@pytest.mark.parametrize("form", ["jsonl", "csv"])
def test_sets_read_back(spark, tmp_path, form):
    frame = spark.createDataFrame(ROWS, "id long, t string, x double").repartition(3)
    record_sets.write_set(frame, str(tmp_path), form)
    record_sets.write_set(frame.filter("id = 1"), str(tmp_path), form)
    back = record_sets.read_sets(spark, str(tmp_path), "id long, t string, x double", form)
    want = ROWS + ROWS[:1] if form == "jsonl" else [(i, t or None, x) for i, t, x in ROWS + ROWS[:1]]
    assert sorted(map(tuple, back.collect()), key=str) == sorted(want, key=str)
    assert {n[:4] for n in os.listdir(tmp_path)} == {"set-"}
    record_sets.write_set(frame.filter("id = 2"), str(tmp_path), form, "overwrite")
    assert record_sets.read_sets(spark, str(tmp_path), "id long, t string, x double", form).count() == 1


def test_nothing_is_left_of_a_failed_write(spark, tmp_path):
    broken = spark.range(100).repartition(4).select("id", F.when(F.col("id") == 57, F.raise_error(F.lit("broken"))).otherwise("x").alias("t"))
    with pytest.raises(Exception, match="broken"):
        record_sets.write_set(broken, str(tmp_path))
    assert os.listdir(tmp_path) == []


def test_a_failed_attempt_leaves_no_rows(spark, tmp_path):
    """What an attempt wrote that isn't in the commit goes; the set has the other attempt's rows alone."""
    writer = record_sets._Batch(str(tmp_path), "jsonl", ["id"])

    def dies():
        yield {"id": 1}
        raise OSError("executor lost")

    with pytest.raises(OSError):
        writer.write(dies())
    told = [writer.write(iter([{"id": 1}])), writer.write(iter([]))]
    assert not [n for n in os.listdir(tmp_path) if n.startswith("set-")]
    writer.commit(told)
    assert [r["id"] for r in record_sets.read_sets(spark, str(tmp_path), "id long").collect()] == [1]


def test_stream_of_sets_with_restart(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(json.dumps({"id": 10 * k + n}) for n in range(4)))
        stream = spark.readStream.schema("id long").json(str(tmp_path / "in"))
        record_sets.stream_sets(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    found = record_sets.read_sets(spark, str(tmp_path / "out"), "id long")
    assert sorted(r["id"] for r in found.collect()) == [10 * k + n for k in range(3) for n in range(4)]
    again = record_sets._Stream(str(tmp_path / "out"), "jsonl", ["id"])
    again.commit([again.write(iter([{"id": 99}]))], 0)  # committed before
    assert found.count() == 12 and len(os.listdir(tmp_path / "out")) == 3


def test_cells_of_pages(spark):
    from colophon.sources import readers

    pages = [
        (1, "<table><tr><td>a<td>b<tr><th>c</table><table><tr></tr><tr><td> x\n y </td></tr>"),
        (2, "<table><tr><td>out<table><tr><td>in</td></tr></table>er</td><td>z</td></tr></table>"),
        (3, "no table"), (4, ""), (5, None), (6, "<table>" + "<tr><td>r</td></tr>" * 5000 + "</table>"), (1, "<td>stray</td>"),
    ]
    frame = spark.createDataFrame(pages, "page int, html string").withColumn("text", F.lit("clash"))
    found = readers.html_cells(frame)
    assert found.columns == ["page", "tbl", "row", "col", "text"]
    got = sorted(tuple(r) for r in found.filter("page < 6").collect())
    assert got == [
        (1, 0, 0, 0, "a"), (1, 0, 0, 1, "b"), (1, 0, 1, 0, "c"), (1, 1, 1, 0, "x y"),
        (2, 0, 0, 0, "outer"), (2, 0, 0, 1, "z"), (2, 1, 0, 0, "in"),
    ]
    assert found.filter("page = 6").count() == 5000
