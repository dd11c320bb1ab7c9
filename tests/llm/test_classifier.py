import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from colophon.llm import rulefit
from colophon.llm.queries import op5_quality_classifier


def documents(n, seed=6):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.3
        words = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(20, 90))]
        rows.append((i, " ".join(w + ("###" if bad and rng.random() < 0.4 else "") for w in words)))
        labels.append((i, int(not bad)))
    return rows, labels


def ensemble_of(x):
    rng = np.random.default_rng(3)
    rules = []
    for _ in range(25):
        ks = rng.choice(len(rulefit.NAMES), size=rng.integers(1, 4), replace=False)
        rules.append((float(rng.normal()), tuple((int(k), bool(rng.random() < 0.5), float(rng.choice(x[:, k]))) for k in ks)))
    return rulefit.RuleEnsemble(0.3, tuple(rules))


def test_compiled_column_equals_the_rules(spark):
    docs = spark.createDataFrame([*documents(120)[0], (500, None), (501, ""), (502, "x " * 30_000)], "doc_id long, text string")
    found = rulefit.with_statistics(docs).select("_all.doc_id", "_stats.*").toPandas().set_index("doc_id")
    x = found[list(rulefit.NAMES)].to_numpy(float)
    ensemble = ensemble_of(x)
    total = ensemble.bias + sum(w * rulefit.meets(x, rule) for w, rule in ensemble.rules)
    want = dict(zip(found.index, 1 / (1 + np.exp(-total))))
    got = {r["doc_id"]: r["score"] for r in rulefit.score(docs, ensemble).collect()}
    assert got == pytest.approx(want)


def test_lasso_meets_its_optimality_conditions():
    rng = np.random.default_rng(5)
    a = (rng.random((400, 12)) < 0.4).astype(float)
    y = (rng.random(400) < 1 / (1 + np.exp(-(2 * a[:, 0] - 1.5 * a[:, 1])))).astype(float)
    penalty = 0.02
    bias, w = rulefit._lasso(a, y, penalty, 5000)
    error = 1 / (1 + np.exp(-(a @ w + bias))) - y
    slope = a.T @ error / len(y)
    assert abs(error.mean()) < 1e-4
    assert np.all(np.abs(slope[w != 0] + penalty * np.sign(w[w != 0])) < 1e-4)
    assert np.all(np.abs(slope[w == 0]) <= penalty + 1e-4) and 1 <= (w != 0).sum() < 12


def test_query_holds_out_and_predicts(spark, tmp_path):
    rows, labels = documents(300)
    rows += [(300, None), (301, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    found = op5_quality_classifier(spark, str(tmp_path)).collect()
    assert len(found) == 302
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r["predicted"] == dict(labels)[r["doc_id"]] for r in found if r["held_out"] and r["doc_id"] < 300]
    assert np.mean(held) > 0.95


def test_repeated_rows_clashes_and_empty_tables(spark):
    rows, labels = documents(200)
    plain, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    often = plain.unionByName(plain.filter("doc_id = 3").crossJoin(spark.range(500)).drop("id"))
    both = known.unionByName(known.filter("doc_id = 7").withColumn("quality", 1 - F.col("quality")))
    assert rulefit.fit(often, known) == rulefit.fit(plain, known)
    assert rulefit.fit(plain, both) == rulefit.fit(plain.filter("doc_id <> 7"), known)
    ensemble = rulefit.fit(plain, known)
    clash = plain.withColumns({"score": F.lit("x"), "n_words": F.lit("y"), "_stats": F.lit("z")})
    found = rulefit.score(clash, ensemble)
    assert found.columns == ["doc_id", "text", "n_words", "_stats", "score"] and found.first()["n_words"] == "y"
    assert rulefit.score(plain.limit(0), ensemble).count() == 0
    assert rulefit.fit(plain.limit(0), known).rules == () == rulefit.fit(plain, known.limit(0)).rules
