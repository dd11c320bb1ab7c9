import random
from hashlib import sha256

import numpy as np
from pyspark.sql import functions as F

from colophon.llm import suffix


def brute(rows, length):
    first = {}
    coded = [(i, (t or "").encode()) for i, t in rows]
    for i, b in coded:
        for k in range(len(b) - length + 1):
            s = b[k : k + length]
            first[s] = min(first.get(s, i), i)
    out = []
    for i, b in coded:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, sha256(kept).hexdigest()))
    return sorted(out)


def corpus():
    rng = random.Random(11)
    words = ["alpha", "béta", "gamma", "δ", "x", "yy", "the", "of"]
    passages = [" ".join(rng.choice(words) for _ in range(n)) for n in (9, 14, 30, 60)]
    rows = []
    for i in range(80):
        parts = [" ".join(rng.choice(words) + str(rng.randrange(3)) for _ in range(rng.randrange(30))) for _ in range(3)]
        for _ in range(rng.randrange(4)):
            parts.insert(rng.randrange(4), rng.choice(passages) * rng.randint(1, 3))
        rows.append((i * 3, " ".join(parts)))
    rows += [(500, rows[4][1]), (501, rows[4][1]), (501, rows[4][1]), (502, ""), (503, None), (504, "a" * 400), (1, "a" * 300)]
    rng.shuffle(rows)
    return rows


def test_removed_bytes_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = suffix.repeated_passages(docs, 50, ("n_bytes", "n_removed", "n_spans", "kept_sha256"))
    assert sorted(map(tuple, found.collect())) == brute(rows, 50)


def test_kept_text_is_whole_characters(spark):
    passage = "é" * 60
    rows = [(1, "a" + passage, "x"), (2, "bc" + passage + "z", "y"), (3, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = suffix.repeated_passages(docs, 50, ("kept_text", "kept", "spans"), carry=("lang",)).orderBy("doc_id").collect()
    assert [r["kept_text"] for r in found] == ["a" + passage, "bcz", None]
    assert [r["lang"] for r in found] == ["x", "y", "z"]
    assert bytes(found[1]["kept"]) == "bcz".encode() and [tuple(s) for s in found[1]["spans"]] == [(2, 122)]
    assert suffix.repeated_passages(docs.limit(0)).count() == 0


def test_ranks_order_suffixes():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, size=3000, dtype=np.uint8)
    ranks = suffix.suffix_ranks(data, 30)
    raw = data.tobytes()
    strings = [raw[k : k + 30] for k in range(len(raw) - 29)]
    order = {s: r for r, s in enumerate(sorted(set(strings)))}
    assert ranks.tolist() == [order[s] for s in strings]


def test_parsing_gives_the_same_classes():
    rng = np.random.default_rng(4)
    unit = rng.integers(97, 101, size=700, dtype=np.uint8)
    data = np.concatenate([unit, unit[100:], unit])
    begins, counts = np.array([0, 700, 1300]), np.array([651, 551, 651])
    ranks = suffix.corpus_ranks(data, begins, counts, 50, period=16)
    raw = data.tobytes()
    strings = [raw[k : k + 50] for b, c in zip(begins, counts) for k in range(b, b + c)]
    classes = {}
    for rank, string in zip(ranks.tolist(), strings):
        assert classes.setdefault(rank, string) == string
    assert len(classes) == len(set(strings))


def test_null_ids_come_first(spark):
    docs = spark.createDataFrame([(None, "q" * 90), (None, "q" * 70), (3, "q" * 80)], "doc_id long, text string")
    found = suffix.repeated_passages(docs, 50, ("n_bytes", "n_removed")).collect()
    assert sorted(map(tuple, found), key=str) == [(3, 80, 80), (None, 70, 0), (None, 90, 0)]


def test_merged_spans():
    assert suffix.merged(np.array([5, 0, 9]), np.array([9, 3, 12])) == [(0, 3), (5, 12)]


def test_least_of_and_rolling():
    data = np.frombuffer(b"abcabcabcxabc", np.uint8)
    h = suffix.rolling(data, 3)
    assert h[0] == h[3] == h[6] == h[10] and h[1] == h[4] and h[7] != h[0]
    values = np.array([5, 3, 8, 1, 9, 7], np.uint64)
    assert suffix.least_of(values, 3).tolist() == [3, 1, 1, 1]


def test_extra_columns_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "q" * 80, 1, 2), (2, "q" * 80, 3, 4)], "doc_id long, text string, block int, id int")
    found = suffix.repeated_passages(docs, 50, ("n_removed",), carry=("block", "id")).orderBy("doc_id")
    assert [tuple(r) for r in found.collect()] == [(1, 1, 2, 0), (2, 3, 4, 80)]
    assert found.select(F.sum("n_removed")).first()[0] == 80


def test_very_long_text_and_repeated_rows(spark):
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefghij ") for _ in range(6_000_000))
    rows = [(1, long[:100]), (2, long), (2, long), (3, long[5_000_000:]), (None, "x" * 60), (None, "x" * 60), (4, "x" * 70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sorted((str(r[0]), r[1], r[2]) for r in suffix.repeated_passages(docs, 50, ("n_bytes", "n_removed")).collect())
    assert found == [("1", 100, 0), ("2", 6_000_000, 100), ("2", 6_000_000, 100), ("3", 1_000_000, 1_000_000), ("4", 70, 70), ("None", 60, 0), ("None", 60, 0)]


def test_blocks_follow_the_input():
    sizes = [0, 1 << 20, 1 << 30, 1 << 35, 1 << 40, 1 << 47]
    found = [suffix.blocks_for(n) for n in sizes]
    assert found == [64, 64, 257, 8193, (1 << 15) + 1, (1 << 22) + 1]


def test_rows_between_stages_follow_the_input():
    import pyarrow as pa

    rng = random.Random(7)
    texts = [bytes(rng.choice(b"abcdefgh") for _ in range(400)) for _ in range(40)]
    rows = pa.table({"id": list(range(40)), "data": texts})
    notes = pa.table({"id": pa.nulls(0, pa.int64()), "digest": pa.nulls(0, pa.string()), "code": pa.nulls(0, pa.int64())})
    few, many = (suffix.report_anchors(0, rows, notes, 50, shares) for shares in (4, 4000))
    assert few.num_rows == many.num_rows < 40 * 400 / 5
    assert len(set(many.column("share").to_pylist())) > 100
