"""The metric index against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from colophon.operators import cells, matching


def plain(queries, base, k, threshold, same):
    out = set()
    for i, q in queries:
        scored = []
        for j, b in base:
            ok = [v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in (q, b)]
            if all(ok) and len(q) == len(b) and (same or i != j):
                scored.append((-round(float(np.dot(q, b) / np.linalg.norm(q) / np.linalg.norm(b)), 9), j))
        out |= {(i, j, -s) for s, j in sorted(scored)[:k] if threshold is None or -s >= threshold}
    return out


def clustered(seed, n, groups, size=8, spread=0.1):
    rng = np.random.RandomState(seed)
    centres = rng.normal(size=(groups, size))
    return [(k, (centres[k % groups] + spread * rng.normal(size=size)).astype(np.float32).astype(float).tolist()) for k in range(n)]


@pytest.mark.parametrize("k,threshold,same", [(1, 0.78, True), (3, None, False), (5, 0.9, True)])
def test_equal_to_all_pairs(spark, monkeypatch, k, threshold, same):
    """Groups, copies, vectors of other lengths, null, zero and broken ones; blocks of a few rows."""
    monkeypatch.setattr(cells, "BASE_BLOCK", 16)
    monkeypatch.setattr(cells, "QUERY_BLOCK", 8)
    rows = clustered(1, 240, 12)
    rows += [(300 + k, rows[5][1]) for k in range(40)]
    rows += [(400, None), (401, [0.0] * 8), (402, [1.0, None, *[0.0] * 6]), (403, [float("nan")] * 8), (404, [1.0, 2.0]), (405, [2.0, 1.0]), (406, []), (407, [3.0])]
    frame = spark.createDataFrame(rows, "id long, vector array<double>").repartition(4)
    asked = [r for r in rows if r[0] % 2 == 0]
    found, met = cells.nearest(frame.filter("id % 2 = 0"), frame, k, threshold, same)
    assert {(r[0], r[1], round(r[2], 9)) for r in found.collect()} == plain(asked, rows, k, threshold, same)
    small = matching.nearest_vectors(frame.filter("id % 2 = 0"), frame, k, threshold, same=same)
    assert {(r[0], r[1], round(r[2], 9)) for r in small.collect()} == plain(asked, rows, k, threshold, same)


def test_compares_few_pairs_of_grouped_vectors(spark):
    rows = clustered(2, 3000, 60, 16)
    frame = spark.createDataFrame(rows, "id long, vector array<double>")
    found, met = cells.nearest(frame.filter("id % 10 = 0"), frame, 5, None)
    pairs = met.agg(F.sum(F.col("queries") * F.col("vectors"))).first()[0]
    assert pairs < 300 * 3000 / 3
    asked = [r for r in rows if r[0] % 10 == 0]
    assert {(r[0], r[1], round(r[2], 9)) for r in found.collect()} == plain(asked, rows, 5, None, True)


def test_vectors_without_groups(spark):
    rng = np.random.RandomState(3)
    rows = [(f"v{k}", rng.normal(size=32).tolist()) for k in range(300)]
    frame = spark.createDataFrame(rows, "id string, vector array<double>")
    found, _ = cells.nearest(frame, frame, 2, None, same=False)
    assert {(r[0], r[1], round(r[2], 9)) for r in found.collect()} == plain(rows, rows, 2, None, False)


def test_empty_sides(spark):
    some = spark.createDataFrame([(1, [1.0, 2.0])], "id long, vector array<double>")
    none = some.filter("id > 1")
    for q, b in ((some, none), (none, some), (none, none)):
        assert cells.nearest(q, b, 2, 0.5)[0].collect() == []
