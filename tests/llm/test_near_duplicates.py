import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from colophon.llm import minhash, pivots

WORDS = [f"w{i}" for i in range(400)]


def text_of(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def corpus():
    rng = random.Random(5)
    base = [text_of(rng, rng.randint(1, 120)) for _ in range(40)]
    docs = list(base)
    for text in base:
        for _ in range(rng.randint(0, 3)):
            words = text.split()
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            docs.append(" ".join(words))
    shared = text_of(rng, 60)
    docs += [shared + " " + text_of(rng, 12) for _ in range(30)]  # a dense group near the threshold
    docs += ["", None, "  \n", "one two", "One  TWO", base[0], base[0].upper()]
    rng.shuffle(docs)
    return list(enumerate(docs, 3))


def brute_components(rows, k, percent):
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[j : j + k]) for j in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} - {()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("block_rows", [1024, 5])
def test_components_equal_brute_force(spark, block_rows):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = minhash.near_duplicates(docs, words=4, block_rows=block_rows).collect()
    assert {r[0]: (r[1], r[2]) for r in found} == brute_components(rows, 4, 80)


def test_deduplicate_keeps_columns_and_one_row(spark):
    rows = [(1, "a b c d e f g", 5), (2, "A b c d e f g", 6), (2, "A b c d e f g", 6), (3, None, 7), (4, "", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    kept = minhash.deduplicate(docs)
    assert kept.columns == ["doc_id", "text", "n"]
    assert sorted(r[0] for r in kept.collect()) == [1, 3, 4]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_rows_without_id_are_documents(spark):
    rng = random.Random(9)
    a, b, c = (text_of(rng, 60) for _ in range(3))
    rows = [(None, a), (7, a + " end"), (None, b), (None, b), (None, b + " end"), (None, c), (None, None), (None, ""), (2, text_of(rng, 60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = minhash.near_duplicates(docs).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["2", "7"] + ["None"] * 7
    assert sum(r["kept"] for r in found) == len({r["component_id"] for r in found}) == 6
    assert sum(r["component_id"] == 7 for r in found) == 2
    kept = [tuple(r) for r in minhash.deduplicate(docs).collect()]
    assert sorted((str(i), str(t)) for i, t in kept if t not in (b, b + " end")) == sorted((str(i), str(t)) for i, t in [(7, a + " end"), (None, c), (None, None), (None, ""), rows[-1]])
    assert sum(t in (b, b + " end") for _, t in kept) == 1
    bare = docs.filter("doc_id is null")
    assert minhash.deduplicate(bare).count() == 5
    full = docs.limit(1).selectExpr(f"{(1 << 63) - 1}L as doc_id", "text").union(bare)
    with pytest.raises(ValueError):
        minhash.deduplicate(full)


def test_id_with_two_texts_and_clashing_columns(spark):
    rng = random.Random(4)
    a, b = text_of(rng, 60), text_of(rng, 60)
    rows = [(1, a, 1, "x"), (1, b, 2, "y"), (1, b, 2, "y"), (2, a + " end", 3, "z"), (3, b + " end", 4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int, component_id string").repartition(3)
    kept = minhash.deduplicate(docs)
    assert kept.columns == docs.columns
    texts = sorted((r["doc_id"], r["text"]) for r in kept.collect())
    assert len(texts) == 2 and texts[0] == (1, a) or texts == [(1, b), (2, a + " end")]
    found = minhash.near_duplicates(docs)
    assert sorted(r["doc_id"] for r in found.collect()) == [1, 1, 1, 2, 3]
    assert len({r["component_id"] for r in found.collect()}) == 2


def test_very_long_text(spark):
    rng = random.Random(8)
    long = " ".join(rng.choice(WORDS) for _ in range(400_000))
    docs = spark.createDataFrame([(1, long), (2, long + " end"), (3, "x")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in minhash.deduplicate(docs).collect()) == [1, 3]


def test_fewest_agreeing_bins_is_safe():
    rng = np.random.default_rng(2)
    for percent in (50, 80, 95):
        bound = minhash.fewest_agreeing(96, percent)
        assert rng.binomial(96, percent / 100, 100_000).min() >= bound - 1
    assert minhash.bands_for(80, 4) == 24


def test_sketch_fills_all_bins_and_estimates():
    rng = np.random.default_rng(1)
    for n in (1, 3, 40, 5000):
        values = minhash.sketch(np.unique(rng.integers(1 << 62, size=n, dtype=np.uint64)), 96)
        assert values.max() != np.uint64(0xFFFFFFFFFFFFFFFF)
    a = rng.integers(1 << 62, size=1000, dtype=np.uint64)
    b = np.concatenate([a[:900], rng.integers(1 << 62, size=100, dtype=np.uint64)])
    agree = np.mean(minhash.sketch(np.unique(a), 2000) == minhash.sketch(np.unique(b), 2000))
    assert abs(agree - 900 / 1100) < 0.05


def test_word_hashes_follow_texts_and_spaces():
    import pyarrow as pa

    texts = ["a b c d", "a\tb\nc  d ", "x", "", "ab c d"]
    sets = [s.tolist() for s in minhash.shingle_sets(pa.array(texts), 4)]
    assert sets[0] == sets[1] and len(sets[2]) == 1 and sets[3] == [] and sets[4] != sets[0]


def brute_links(rows, threshold):
    links = defaultdict(set)
    for i, v in rows:
        for j, w in rows:
            if i < j and good(v) and good(w) and len(v) == len(w):
                a, b = np.array(v, float), np.array(w, float)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    out = {}
    for i, _ in rows:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(links[i]), min(seen))
    return out


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def test_vector_links_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows, k = [], 0
    for size in (1, 2, 3, 60, 1, 1, 5) + (1,) * 40:
        center = rng.normal(size=16)
        for _ in range(size):
            rows.append((k, (center + rng.normal(size=16) * 0.12).tolist()))
            k += 1
    rows += [(k, rows[0][1]), (k + 1, [2 * x for x in rows[0][1]]), (k + 2, None), (k + 3, []), (k + 4, [0.0] * 16)]
    rows += [(k + 5, [float("nan")] * 16), (k + 6, [None] + [1.0] * 15), (k + 7, [float("inf")] * 16), (k + 8, [1.0] * 3)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for block in (1024, 7):
        found = pivots.near_duplicates(vectors, 0.95, block_rows=block).collect()
        got, want = {r[0]: (r[1], r[2]) for r in found}, brute_links(rows, 0.95)
        assert set(got) == set(want)
        total = sum(n for n, _ in want.values())
        assert all(got[i][0] <= want[i][0] for i in want)  # none below the threshold
        assert sum(n for n, _ in got.values()) >= 0.9 * total > 0


@pytest.mark.parametrize("common", [0.0, 2.0])
def test_recall_at_the_threshold(spark, common):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1500, 48)) / 48**0.5
    x[:, 0] += common  # two vectors have a cosine of 0.8 then
    x = pivots.unit(x)
    to = rng.normal(size=x.shape)
    to = pivots.unit(to - (to * x).sum(axis=1, keepdims=True) * x)
    cosine = rng.uniform(0.951, 0.96, size=(len(x), 1))
    y = cosine * x + np.sqrt(1 - cosine**2) * to
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([x, y]))]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    both = np.concatenate([x, y])
    want = ((both @ both.T >= 0.95).sum(axis=1) - 1).tolist()
    got = {r[0]: r[1] for r in pivots.near_duplicates(vectors).collect()}
    assert all(got[k] <= n for k, n in enumerate(want))
    assert sum(got.values()) >= 0.95 * sum(want)


def test_lengths_and_clashing_columns(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0, 0.0], 2), (3, [1.0, 0.01, 0.0], 3), (4, [2.0, 0.0], 4), (5, [0.0, 1.0], 5), (5, [0.0, 1.0], 5)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int")
    found = sorted(map(tuple, pivots.near_duplicates(vectors).collect()))
    assert found == [(1, 1, 1), (2, 1, 2), (3, 1, 2), (4, 1, 1), (5, 1, 5), (5, 1, 5)]


def test_no_usable_vectors(spark):
    vectors = spark.createDataFrame([(1, None), (2, [0.0, 0.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, pivots.near_duplicates(vectors).collect())) == [(1, 0, 1), (2, 0, 2)]
    assert pivots.near_duplicates(vectors.limit(0)).count() == 0


def test_bucket_sets_once(spark):
    entries = spark.createDataFrame([(1, 10), (2, 10), (1, 11), (2, 11), (3, 12), (1, 13), (3, 13)], "rep long, key long")
    found = minhash.shared_buckets(entries).groupBy("group").agg(F.sort_array(F.collect_list("rep")).alias("m")).collect()
    assert Counter(tuple(r["m"]) for r in found) == {(1, 2): 1, (1, 3): 1}


def test_vectors_without_ids_link(spark):
    rows = [(None, [1.0, 0.01]), (3, [1.0, 0.0]), (None, [0.0, 1.0]), (None, [0.001, 1.0]), (None, None), (9, [-1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted(map(tuple, pivots.near_duplicates(vectors).collect()), key=str)
    linked = [r for r in found if r[1]]
    assert sorted(map(str, linked)) == sorted(map(str, [(None, 1, 3), (3, 1, 3), *[(None, 1, linked[0][2] if linked[0][2] > 9 else linked[1][2])] * 2]))
    assert {r[2] for r in linked if r[2] > 9} and len(found) == 6 and (9, 0, 9) in found
