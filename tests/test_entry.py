import json

import pytest

import __spark_entry__
from colophon import cli, queries

SMALL = "/root/testdata/sf0.001"


def test_names():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(queries.QUERIES) <= set(__spark_entry__.queries())


def test_flagship(spark):
    assert {r["bucket"] for r in __spark_entry__.entry(spark).collect()} <= {1, 2, 3, 4, 5}


@pytest.mark.parametrize("name", [
    "orphan_papers", "topic_distribution", "wos_cascade", "vector_nn", "seq_ids", "doi_validate", "fuzzy_clients", "wos_fuzzy", "vector_index_nn", "phrase_search", "stored_queries",
    "works_pushdown", "event_sets", "stream_ingest", "html_cells", "load_statistics", "stage_1_matched", "audit_rows", "bucketed_upsert",
])
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for t in "orders lineitem documents part embeddings pages clients items events customer nation benchmark".split():
        connection.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    found = connection.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    made = queries.QUERIES[name](spark, SMALL)
    assert sorted(made.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, made.select(*columns).collect()))) == sorted(map(str, found.fetchall()))


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "w.jsonl").write_text(json.dumps({"id": "https://x/W1", "title": "Quantum sensing", "authorships": []}))
    assert cli.main(["convert-to-db", "--db", str(tmp_path / "db"), "--input", str(tmp_path / "w.jsonl")]) == 0
    assert cli.main(["check-db", "--db", str(tmp_path / "db")]) == 0 and "papers" in capsys.readouterr().out
