"""The co-bucketed pair against a plain version in pyarrow and Python."""

import hashlib
import os
import zlib
from collections import Counter
from datetime import datetime

import pyarrow.parquet as pq

from colophon.llm import copair, queries

SMALL = "/root/testdata/sf0.001"


def crc(text: str) -> int:
    return zlib.crc32(text.encode())


def rank(row: dict, columns: list[str], key: str) -> tuple:
    def up(value):
        return (value is not None, value.encode() if isinstance(value, str) else value if value is not None else 0)

    own = row[key]
    return ((own is not None, -own if own is not None else 0), *(up(row[c]) for c in columns if c != key))


def plain(tables: dict[str, list[dict]], columns: dict[str, list[str]], buckets: int = 150) -> list[tuple]:
    """(table, bucket, ids digest, lineage digest, rows, joined, rewritten) and the rows of each file."""

    def digest(parts):
        return hashlib.sha256(",".join(parts).encode()).hexdigest()

    sales = Counter(r["sale_id"] for r in tables["sales"] if r["sale_id"] is not None)
    lines = Counter(r["sale_id"] for r in tables["sale_lines"] if r["sale_id"] in sales)
    joined = Counter()
    for k, n in lines.items():
        joined[crc(f"pair{k}") % buckets] += n * sales[k]
    out = {}
    for name, rows in tables.items():
        placed = []
        for r in rows:
            k = r["sale_id"]
            own = buckets + 1 if k is None else crc(f"pair{k}") % buckets
            if name == "sales":
                start, bucket = (own - 1 if own % 5 == 1 else own), own
            else:
                start = 0 if r["item_id"] is None else crc(str(r["item_id"])) % buckets
                bucket = own if k is None or k in sales else buckets
            placed.append((start, bucket, r))
        by_start, by_bucket = Counter(s for s, _, _ in placed), Counter(b for _, b, _ in placed)
        for b in by_bucket:
            mine = sorted((r for _, c, r in placed if c == b), key=lambda r: rank(r, columns[name], "sale_id"))
            from_ = Counter(s for s, c, _ in placed if c == b)
            stays = any(n == by_start[s] == by_bucket[b] for s, n in from_.items())
            ids = digest("" if r["sale_id"] is None else str(r["sale_id"]) for r in mine)
            lineage = digest(f"{s}:{n}" for s, n in sorted(from_.items()))
            out[name, b] = ((ids, lineage, len(mine), joined.get(b, 0), not stays), mine)
    return out


def compare(found, expected, columns, root=None):
    got = {}
    for r in found:
        assert r["columns"] == ",".join(columns[r["table_name"]])
        file = pq.ParquetFile(r["path"])
        assert file.schema_arrow.names == columns[r["table_name"]]
        key = (r["table_name"], r["bucket"])
        assert key not in got
        got[key] = (r["ids_sha256"], r["lineage_sha256"], r["n_rows"], r["n_joined"], r["rewritten"])
        rows = file.read().to_pylist()
        assert [tuple(x.values()) for x in rows] == [tuple(x.values()) for x in expected[key][1]], key
    assert got == {k: v[0] for k, v in expected.items()}
    if found:
        for folder in {os.path.dirname(r["path"]) for r in found}:
            there = {f for f in os.listdir(folder) if not f.endswith(".crc")}
            assert there == {os.path.basename(r["path"]) for r in found if os.path.dirname(r["path"]) == folder}


def test_query_equals_plain_version(spark):
    tables, columns = {}, {}
    for name in ("sales", "sale_lines"):
        t = pq.read_table(f"{SMALL}/{name}.parquet")
        tables[name], columns[name] = t.to_pylist(), t.schema.names
    first = queries.op13_co_bucketed_pair(spark, SMALL).collect()
    compare(first, plain(tables, columns), columns)
    again = queries.op13_co_bucketed_pair(spark, SMALL).collect()
    assert not {r["path"] for r in first} & {r["path"] for r in again}


def write(spark, folder, sales, lines):
    day = datetime(2024, 1, 1)
    kinds = {
        "sales": "sale_id long, client_id long, status string, _bucket double, sold_at timestamp_ntz",
        "sale_lines": "sale_id long, line_no int, item_id long, flag string, _metadata string",
    }
    rows = {
        "sales": [(k, c, s, x, day) for k, c, s, x in sales],
        "sale_lines": [(k, n, i, f, m) for k, n, i, f, m in lines],
    }
    made = {n: spark.createDataFrame(rows[n], kinds[n]) for n in kinds}
    for n, df in made.items():
        df.write.parquet(f"{folder}/{n}.parquet")
    columns = {n: df.columns for n, df in made.items()}
    return {n: [r.asDict() for r in df.collect()] for n, df in made.items()}, columns


def test_odd_rows(spark, tmp_path):
    """Nulls in any column, empty and very long texts, repeated rows, orphans, clashing names, a hot key."""
    sales = [(None, 1, "open", 1.5), (None, None, None, None), (5, 2, "", None), (5, 2, "", None), (-7, None, "é\U0001f600", 0.0), (-7, None, "￿", 0.0)]
    sales += [(k, k % 3, "x" * (k % 4), float(k)) for k in range(40)]
    lines = [(None, 1, None, "a", "m"), (5, 2, 9, None, None), (5, 2, 9, None, None), (999, 1, 3, "", "z" * 200_000), (-7, 3, None, "q", "")]
    lines += [(5, k % 7, k, "hot", None) for k in range(300)] + [(k, 1, k, "f", "m") for k in range(60)]
    tables, columns = write(spark, tmp_path, sales, lines)
    found = queries.op13_co_bucketed_pair(spark, str(tmp_path)).collect()
    expected = plain(tables, columns)
    compare(found, expected, columns)
    assert {r["bucket"] for r in found if r["table_name"] == "sale_lines"} >= {150, 151}
    stayed = [r for r in found if r["table_name"] == "sales" and r["bucket"] == 151]
    assert [r["rewritten"] for r in stayed] == [False] and "part-00150" in stayed[0]["path"]  # another number


def test_empty_tables(spark, tmp_path):
    tables, columns = write(spark, tmp_path / "a", [], [])
    assert queries.op13_co_bucketed_pair(spark, str(tmp_path / "a")).collect() == []
    tables, columns = write(spark, tmp_path / "b", [], [(1, 1, 1, "a", None), (None, 1, 2, "b", None)])
    compare(queries.op13_co_bucketed_pair(spark, str(tmp_path / "b")).collect(), plain(tables, columns), columns)


def test_other_key_and_buckets(spark, tmp_path):
    """The operator on tables of other names, with files numbered by chance."""
    left = spark.createDataFrame([(k, f"n{k % 5}") for k in range(50)], "k long, name string")
    right = spark.createDataFrame([(f"v{k}", k % 60) for k in range(200)], "v string, k long")
    folders, schemas = {}, {}
    for name, df in (("l", left), ("r", right)):
        folders[name], schemas[name] = str(tmp_path / name), df.schema
        numbered = df.selectExpr("*", "cast(pmod(hash(*), 7) as int) as number")
        copair.write_numbered(numbered, "number", 7, "k", folders[name])
    found = copair.rewrite(spark, folders, schemas, "k", 4, "s").collect()
    for r in found:
        rows = pq.read_table(r["path"]).to_pylist()
        expected = {4} if r["bucket"] == 4 else {r["bucket"]}
        assert {4 if x["k"] >= 50 else crc(f"s{x['k']}") % 4 for x in rows} == expected
        assert [x["k"] for x in rows] == sorted((x["k"] for x in rows), reverse=True)
    assert sum(r["n_rows"] for r in found) == 250
    assert sum({r["bucket"]: r["n_joined"] for r in found}.values()) == sum(1 for k in range(200) if k % 60 < 50)
