"""The Merkle manifest against a plain tree over lists."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from colophon.llm import merkle, queries


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values) -> str:
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes: list[str]) -> tuple[str, list[list[tuple[list[str], int]]]]:
    """The root and, for each leaf, (run, place in it) level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, path in enumerate(paths):
            run = at[k] // 8
            path.append((nodes[8 * run : 8 * run + 8], at[k] % 8))
            at[k] = run
        nodes = [h(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)]
    return nodes[0], paths


def plain(rows: list[tuple]) -> list[tuple]:
    """Rows (doc_id, source, lang, n_chars, text) to the query's result."""
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        mine = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees.append((mine, *climb([leaf(*r) for r in mine])))
    root, tops = climb([t[1] for t in trees])
    out = []
    for (mine, subroot, paths), top in zip(trees, tops):
        for r, path in zip(mine, paths):
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            text = r[4]
            if changed and text is not None:
                text = "".join(c.lower() if c.isascii() else c for c in text)
            now, others = leaf(*r[:4], text), []
            for run, k in path + top:
                others += run[:k] + run[k + 1 :]
                now = h(*run[:k], now, *run[k + 1 :])
            out.append((r[0], r[2], leaf(*r), subroot, root, h(*others), now, now == root))
    return out


COLUMNS = ["doc_id", "lang", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
KINDS = "doc_id long, source string, lang string, n_chars long, text string, part int, leaf string"


def check(spark, tmp_path, rows):
    wide = [(*r, 1, "clash") for r in rows]
    spark.createDataFrame(wide, KINDS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_merkle_manifest(spark, str(tmp_path)).select(*COLUMNS)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, plain(rows) if rows else []))


def rows_of(seed: int, n: int, langs: list) -> list[tuple]:
    rnd = random.Random(seed)
    return [(k, rnd.choice(["a", None, ""]), rnd.choice(langs), rnd.choice([None, k]), rnd.choice(["", None, f"Text É {k}", "UPPER", "low"])) for k in range(n)]


@pytest.mark.parametrize("range_rows", [1, 7, 40, 100_000])
def test_ranges_of_any_length(spark, tmp_path, monkeypatch, range_rows):
    """One lang with most rows, langs of one row, null and empty langs, repeated rows and ids, null ids."""
    monkeypatch.setattr(merkle, "RANGE_ROWS", range_rows)
    n = 60 if range_rows == 1 else 700
    rows = rows_of(1, n, ["en"] * 12 + ["de", "fr", None, "", "é"])
    rows += [(None, None, "en", None, None)] * 3 + [(5, "a", "en", 5, "Twice")] * 20 + [(10_000 + k, "s", f"l{k}", 1, "Only") for k in range(9)]
    check(spark, tmp_path, rows)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_sizes(spark, tmp_path, monkeypatch, n):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 10)
    check(spark, tmp_path, [(k, "s", "en", k, f"Text {k}") for k in range(n)])


def test_many_langs_and_long_text(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 30)
    check(spark, tmp_path, [(k, "s", f"l{k % 150:03}", k, "A" * 1_200_000 if k == 7 else "B") for k in range(300)])


def test_empty_table(spark, tmp_path):
    check(spark, tmp_path, [])
    none = spark.createDataFrame([], "group string, place long, leaf string, seen string")
    assert merkle.manifest_root(none) is None


def test_root_and_missing_leaves(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 9)
    leaves = spark.range(100).select(F.lit("g").alias("group"), F.col("id").alias("place"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    root = climb([h(str(k)) for k in range(100)])[0]
    assert merkle.manifest_root(leaves) == root
    found = merkle.manifest(leaves.withColumn("seen", F.when(F.col("place") != 3, F.col("leaf"))))
    assert {r["place"] for r in found.filter("not verified").collect()} == {3}
    assert {r["root"] for r in found.collect()} == {root}


def test_merge_in_any_order():
    """Forests of ranges merge to the same root, whatever meets first."""
    leaves = [h(str(k)) for k in range(531)]
    nodes = [bytes.fromhex(x) for x in leaves]
    cuts = [0, 3, 4, 70, 71, 200, 520, 531]
    for seed in range(10):
        parts = [merkle.forest([nodes[a:b]], (0, a, 531, 531, 1)) for a, b in zip(cuts, cuts[1:])]
        rnd = random.Random(seed)
        while len(parts) > 1:
            a = parts.pop(rnd.randrange(len(parts)))
            parts[rnd.randrange(len(parts))].merge(a)
        assert parts[0].root.hex() == climb(leaves)[0]
        assert len(parts[0].seams) <= 4 * (len(cuts) - 2)
