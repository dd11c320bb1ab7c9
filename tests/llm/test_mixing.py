"""Mixing against plain versions of its targets, its rounding and its balance."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from colophon.llm import mixing, queries


def plain_targets(sizes: dict) -> dict:
    """Shares by weight; what is over three times a source's size is shared again until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "")))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    full: set = set()
    total = sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        heavy = sum(weight[s] for s in sizes if s not in full)
        target = {s: 3.0 * sizes[s] if s in full else weight[s] * rest / heavy for s in sizes}
        over = {s for s in sizes if s not in full and target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def plain(rows: list[tuple]) -> list[tuple]:
    """(doc_id, size, source_size, target, taken), rounding as the docstring says, one document after the other."""
    docs = [(d, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s) for d, t, s in rows]
    sizes: Counter = Counter()
    for _, n, s in docs:
        sizes[s] += n
    target, out = plain_targets(sizes), []
    for s in sizes:
        by_size = defaultdict(list)
        for d in docs:
            if d[2] == s:
                by_size[d[1]].append(d)
        carry, rate = 0.0, round(target[s] / sizes[s], 11) if sizes[s] else 0.0
        for n in sorted(by_size, reverse=True):
            owed = carry + len(by_size[n]) * rate * n
            k = max(0, min(3 * len(by_size[n]), math.floor(owed / n + 0.5))) if n else 0
            carry = owed - k * n
            ranked = sorted(by_size[n], key=lambda d: hashlib.md5(("" if d[0] is None else str(d[0])).encode()).hexdigest())
            for at, d in enumerate(ranked):
                out.append((d[0], n, sizes[s], target[s], n * (k // len(ranked) + (at < k % len(ranked)))))
    return out


def write(spark, folder, rows):
    wide = [(*r, "x", 1) for r in rows]
    spark.createDataFrame(wide, "doc_id long, text string, source string, stratum string, size int").repartition(3).write.parquet(f"{folder}/documents.parquet")
    return queries.op12_source_mixing(spark, str(folder)).select("doc_id", "size", "source_size", "target", "taken")


def same(found, expected):
    found = sorted(map(tuple, found.collect()), key=str)
    expected = sorted(expected, key=str)
    assert [r[:3] + r[4:] for r in found] == [r[:3] + r[4:] for r in expected]
    assert [r[3] for r in found] == pytest.approx([r[3] for r in expected])


def rows_of(seed: int, n: int) -> list[tuple]:
    rnd = random.Random(seed)
    sources = ["hot"] * 12 + ["a", "b", "é", "￿", "\U0001f600", None, "", "tiny"]
    rows = [(k, " ".join(["w"] * rnd.choice([0, 1, 5, 50, 50, 50, rnd.randrange(900)])), rnd.choice(sources)) for k in range(n)]
    rows += [(None, None, "a"), (None, "no id", "a"), (7, "again", "a"), (7, "again", "a"), (n, "l" + " l" * 200_000, "long"), (n + 1, " \t\n", "blank")]
    return rows


def test_query_equals_plain_version(spark, tmp_path):
    rows = rows_of(3, 1500)
    found = write(spark, tmp_path, rows)
    same(found, plain(rows))
    again = queries.op12_source_mixing(spark, str(tmp_path))
    assert sorted(map(str, again.collect())) == sorted(map(str, queries.op12_source_mixing(spark, str(tmp_path)).collect()))
    for r in found.collect():
        assert 0 <= r["taken"] <= 3 * r["size"]


def test_targets_are_met(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(k, " ".join(["w"] * min(4000, int(rnd.paretovariate(1.1) * 20))), f"s{k % 9 if k % 3 else 0}") for k in range(3000)]
    found = write(spark, tmp_path, rows)
    got = found.groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert len(got) == 7 and all(abs(r["taken"] - r["target"]) <= 20 for r in got)
    assert sum(r["target"] for r in got) == pytest.approx(sum(r["source_size"] for r in got))


def test_hot_length_in_parts(spark, tmp_path, monkeypatch):
    """A length of many documents is ranked in parts; its copies stay as many, and each has as many as its peers or one more."""
    monkeypatch.setattr(mixing, "HOT_ROWS", 50)
    monkeypatch.setattr(mixing, "CHAIN", 4)
    rows = [(k, "one two three", "hot") for k in range(2000)] + [(9000 + k, " ".join("x" * k), "rest") for k in range(1, 40)]
    found = write(spark, tmp_path, rows).collect()
    hot = [r for r in found if r["source_size"] == 6000]
    assert abs(sum(r["taken"] for r in hot) - hot[0]["target"]) <= 2
    assert max(r["taken"] for r in hot) - min(r["taken"] for r in hot) <= 3
    rest = [r for r in found if r["source_size"] != 6000]
    assert abs(sum(r["taken"] for r in rest) - rest[0]["target"]) <= 40


def test_empty_tables_and_texts(spark, tmp_path):
    assert write(spark, tmp_path / "a", []).collect() == []
    rows = [(1, None, "a"), (2, "", None)]
    same(write(spark, tmp_path / "b", rows), [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)])


def test_two_margins(spark):
    """Rates meet the targets of sources and languages at once and are a product of one factor each."""
    size = {(s, l): 1000 + 137 * s * (l + 2) for s in range(4) for l in range(3)}
    strata = spark.createDataFrame([(f"s{s}", f"l{l}", n) for (s, l), n in size.items()], "source string, lang string, size long")
    rnd = random.Random(2)
    factor = {**{f"s{s}": rnd.uniform(0.4, 1.5) for s in range(4)}, **{f"l{l}": rnd.uniform(0.5, 1.4) for l in range(3)}}
    wanted = Counter()
    for (s, l), n in size.items():
        for key in (f"s{s}", f"l{l}"):
            wanted[key] += n * factor[f"s{s}"] * factor[f"l{l}"]
    targets = {
        m: spark.createDataFrame([(k, v) for k, v in wanted.items() if k[0] == m[0]], "key string, target double") for m in ("source", "lang")
    }
    found = mixing.rates(strata, ["source", "lang"], targets).collect()
    assert len(found) == 12
    for r in found:
        assert r["rate"] == pytest.approx(factor[r["source"]] * factor[r["lang"]], rel=1e-6)


def test_newton_reaches_the_cap_and_stops_where_nothing_fits(spark):
    strata = spark.createDataFrame([("a", 100), ("b", 1), ("c", 50), ("d", 0)], "source string, size long")
    targets = spark.createDataFrame([("a", 300.0), ("b", 1e-6), ("c", 400.0), ("d", 0.0)], "key string, target double")
    rate = {r["source"]: r["rate"] for r in mixing.rates(strata, ["source"], {"source": targets}).collect()}
    assert rate["a"] == pytest.approx(3) and rate["b"] == pytest.approx(1e-6) and rate["c"] == 3.0
