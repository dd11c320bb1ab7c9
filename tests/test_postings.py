"""Searches by the positional index against the predicate on every text."""

import random

import pytest
from pyspark.sql import functions as F

from colophon.operators import postings
from colophon.plans import boolean


def scan(queries, docs):
    out = set()
    for key, text in queries:
        try:
            tree = boolean.parse(text or "")
        except ValueError:
            continue
        hit = boolean.predicate(tree, F.col("text"))
        out |= {(key, r["doc_id"]) for r in docs.filter(hit).collect()}
    return out


def frames(spark, queries, docs):
    return spark.createDataFrame(queries, "query_id long, query string"), spark.createDataFrame(docs, "doc_id long, text string, place int, run string")


def test_odd_texts_and_terms(spark):
    texts = [
        "The X-ray tube", "x ray  TUBE", "xray", "café au lait", "caf", "Über allem", "über", "c++ code", "c++x", "c ++", "state of\nthe\tart", "state of the  art.", "of the state",
        "", None, " \n", "a b a b a c", "word " * 30000 + "needle in here", "a-b-c", "a - b", "2nd-order", "end++", "(solar) cell", "solar cells",
    ]
    docs = [(k, t, 0, "clash") for k, t in enumerate(texts)] + [(0, "The X-ray tube", 1, None)]
    queries = [
        "x-ray", '"x ray"', "ray AND tube", "caf", "café", "über", "Über", "c++", "c", '"state of the art"', '"of the" AND NOT art', "NOT the", "NOT (a OR b)", '"a b a"', '"a b a c"',
        "needle", "a-b", '"a - b"', "a OR NOT b", "(", "", None, "solar AND cell", '"(solar) cell"', "NOT NOT solar", "2nd-order OR end++", "a NOT a", "zzz", '"needle in" NOT zzz',
    ]
    queries = list(enumerate(queries))
    asked, held = frames(spark, queries, docs)
    assert {tuple(r) for r in postings.search(asked, held).collect()} == scan(queries, held)


@pytest.mark.parametrize("most", [0, 50_000])
def test_random_queries(spark, monkeypatch, most):
    """With tables that are broadcast, and with joins that shuffle."""
    monkeypatch.setattr(postings, "MOST_BROADCAST", most)
    rng = random.Random(4)
    words = ["red", "Fox", "dog", "sun", "moon", "the", "of", "x1"]

    def tree(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.3:
            n = rng.choice([1, 1, 1, 2, 3])
            return rng.choice(words) if n == 1 else '"' + " ".join(rng.choice(words) for _ in range(n)) + '"'
        if kind < 0.45:
            return f"NOT {tree(depth - 1)}" if rng.random() < 0.5 else f"NOT ({tree(depth - 1)} OR {tree(depth - 1)})"
        return "(" + rng.choice([" AND ", " OR ", " "]).join(tree(depth - 1) for _ in range(rng.choice([2, 3]))) + ")"

    docs = [(k, rng.choice([" ", ", ", "\n"]).join(rng.choice(words) for _ in range(rng.randint(0, 12))), 0, None) for k in range(60)]
    queries = [(k, tree(3)) for k in range(50)]
    asked, held = frames(spark, queries, docs)
    assert {tuple(r) for r in postings.search(asked, held).collect()} == scan(queries, held)


def test_filed_under_the_rarest(spark):
    tree = boolean.parse('common AND (rare OR "rarer still") AND NOT never')
    assert postings.required(tree, {"common": 100, "rare": 2, "rarer still": 1, "never": 0}) == {"rare", "rarer still"}
    assert postings.required(boolean.parse("a OR NOT b"), {}) is None


def test_bounds_and_empty_sides(spark):
    asked, held = frames(spark, [(k, f"NOT w{k}") for k in range(postings.MOST_NEGATIVE + 1)], [(1, "text", 0, None)])
    with pytest.raises(ValueError):
        postings.search(asked, held)
    asked, held = frames(spark, [(1, "text")], [(1, "text", 0, None)])
    assert postings.search(asked.limit(0), held).collect() == [] == postings.search(asked, held.limit(0)).collect()
    with pytest.raises(Exception, match="without letters"):
        postings.search(frames(spark, [(1, "++")], [])[0], held).collect()


def test_counting_pass_makes_runs_alone(spark):
    docs = spark.createDataFrame([(1, "The the, x1 Kelvin"), (2, None), (3, ""), (4, "THE é-b")], "doc_id long, text string")
    counted = sorted(r["run"] for r in postings.every_run(docs).collect())
    assert counted == sorted(r["run"] for r in postings.postings(docs).collect())
    assert postings.every_run(docs).columns == ["run"]
