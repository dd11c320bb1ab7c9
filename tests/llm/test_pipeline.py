import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from colophon.llm import pii
from test_near_duplicates import brute_components
from test_passages import brute
from test_pii import brute_force
from test_text_rules import measures

public_tokenizers = pytest.importorskip("public_tokenizers")


def corpus():
    rng = random.Random(21)
    words = [f"{a}{b}{c}" for a in "bcdf" for b in "aeiou" for c in ("n", "rk", "lt")]

    def text(n):
        return " ".join(rng.choice(words) + str(rng.randrange(9)) for _ in range(n))

    passage = text(70)
    rows = [(i, text(rng.randint(30, 90))) for i in range(30)]
    rows += [(100 + i, rows[i][1]) for i in range(5)]  # copies
    rows += [(110 + i, rows[i + 5][1] + " end") for i in range(5)]  # near copies
    rows += [(120 + i, text(60) + " " + passage + " " + text(60)) for i in range(5)]
    rows += [(130, "spam spam spam " * 30), (131, "### ## " * 80), (132, None), (133, "")]
    rows += [(140, text(60) + " mail a.b@c.org or +1 (555) 123-4567, card 4263429643439180")]
    return [(i, t, "en", "s", len(t or "")) for i, t in rows]


def test_stages_against_brute_force(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(corpus(), schema)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    made = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / f"stage{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{k}"))
        made.append([r.asDict() for r in docs.collect()])
        assert k == 4 or docs.columns == list(corpus_pipeline.COLUMNS)

    kept = set()
    for i, text, *_ in corpus():
        n, chars, symbols, lines, dup, repeat = measures(text)
        bad = n < 50 or 100 * repeat > 50 * n or 100 * symbols > 10 * chars or 100 * dup > 50 * lines
        if not bad and 2 * n <= chars <= 25 * n:
            kept.add(i)
    texts = {r["doc_id"]: r["text"] for r in made[0]}
    assert set(texts) == kept

    components = brute_components(list(texts.items()), 5, 80)
    assert {r["doc_id"] for r in made[1]} == {i for i in texts if components[i][1] == i}

    from hashlib import sha256

    rows = [(r["doc_id"], r["text"]) for r in made[1]]
    want = {b[0]: b[4] for b in brute(rows, 50)}
    assert {r["doc_id"]: sha256(r["text"].encode()).hexdigest() for r in made[2]} == want
    assert all(r["n_chars"] == len(r["text"]) for r in made[2])

    after = {r["doc_id"]: r["text"] for r in made[3]}
    assert set(after) == set(want)
    assert after == {r["doc_id"]: brute_force(r["text"], pii.TEST_KEY)[0] for r in made[2]}
    assert "a.b@c.org" not in after[140] and "4263429643439180" not in after[140] and "123-4567" not in after[140]

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    ids = {i: np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4") for i, text in after.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in made[4]:
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes())

    def gapless(parts):
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        return at

    assert {i: gapless(p) for i, p in pieces.items()} == {i: len(x) for i, x in ids.items()}
    assert all(gapless(p) <= 2048 for p in sequences.values())
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= len(after)


def test_documents_without_id_reach_the_end(spark, tmp_path):
    rng = random.Random(4)
    one, two, three = (" ".join(f"{rng.choice('bcdf')}{rng.choice('aeiou')}rk{rng.randrange(99)}" for _ in range(80)) for _ in range(3))
    rows = [(1, one), (None, one), (None, two), (None, two + " end"), (None, three)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    made = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        made.append(docs.collect())
    near, passages, clean = ([(r["doc_id"], r["text"]) for r in rows] for rows in made[1:4])
    assert len(near) == 3 and {(1, one), (None, three)} <= set(near) and {(None, two), (None, two + " end")} & set(near)
    assert sorted(t for _, t in near) == sorted(t for _, t in passages) and len(clean) == 3
    starts = [r["doc_id"] for r in made[4] if r["start"] == 0]
    assert sorted(map(str, starts)) == ["1", "None", "None"]
    assert sum(r["length"] for r in made[4]) == sum(r["doc_tokens"] for r in made[4] if r["start"] == 0)
