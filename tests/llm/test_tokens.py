import random
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest

from colophon.llm import bpe, packing

public_tokenizers = pytest.importorskip("public_tokenizers")
BYTE_PATTERN = public_tokenizers.PATTERN
RANKS, WORDS = map(public_tokenizers.path, ("byte_bpe_50k.tiktoken", "word_bpe_49k.json"))
TEXTS = ["", None, "Hello world, it's 12345!", "  spaces \n\n\tand tabs ", "naïve Äpfel 中文 🙂 é", "a" * 3000, "<|endoftext|>x", "the the the", "ΑΣ ας İ", " "]


def reference():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=BYTE_PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_ids_equal_the_library(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = bpe.encode(docs, RANKS, BYTE_PATTERN, tuple(bpe.OUTPUTS)).collect()
    enc = reference()
    for r in found:
        text = TEXTS[r["doc_id"]] or ""
        ids = enc.encode_ordinary(text)
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert bytes(r["decoded"]) == text.encode() and r["decoded_sha256"] == sha256(text.encode()).hexdigest()
    again = bpe.decode(bpe.encode(docs, RANKS, BYTE_PATTERN), RANKS).collect()
    assert {r[0]: bytes(r[1]) for r in again} == {i: (t or "").encode() for i, t in enumerate(TEXTS)}
    assert bpe.encode(docs.limit(0), RANKS, BYTE_PATTERN).count() == 0


def plain_merges(ranks, piece):
    units = [piece[i : i + 1] for i in range(len(piece))]
    while len(units) > 1:
        rank, k = min((ranks.get(a + b, 1 << 60), k) for k, (a, b) in enumerate(zip(units, units[1:])))
        if rank == 1 << 60:
            break
        units[k : k + 2] = [units[k] + units[k + 1]]
    return [ranks[u] for u in units]


def test_backtracking_equals_merges_on_an_awkward_vocabulary():
    ranks = {bytes([i]): i for i in range(256)}
    for token in (b"ab", b"bc", b"abc", b"cd", b"aa", b"aab", b"bcd", b"dd", b"cdd", b"aaaa", b"bab", b"da"):
        if len(plain_merges(ranks, token)) == 2:
            ranks[token] = len(ranks)
    coder = bpe.ByteBpe(ranks)
    rng = random.Random(1)
    for _ in range(3000):
        piece = bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 14)))
        assert coder.encode_piece(piece) == plain_merges(ranks, piece)


def test_pieces_are_the_documents(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    texts = TEXTS + ["long text " * 3000, "two words", "two words"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs, WORDS, window_tokens=4000, with_ids=True).collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        mine = sorted(pieces[i], key=lambda r: r["start"])
        assert [x for r in mine for x in r["ids"]] == ids
        for r in mine:
            part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4")
            assert r["ids_crc32"] == zlib.crc32(part.tobytes()) and r["doc_tokens"] == len(ids)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048 and (at & (at - 1)) == 0  # nothing to pad
    assert packing.pack(docs.limit(0), WORDS).count() == 0


def test_assignment_balances_cost_and_fills():
    rng = random.Random(2)
    lengths = [rng.choice([3, 50, 700, 1900, 5000]) for _ in range(300)]
    made = packing.assign(lengths, 2048)
    filled, cost = defaultdict(int), defaultdict(float)
    for item, start, n, s, offset in made:
        filled[s] += n
        cost[s] += n * n
    assert sum(filled.values()) == sum(lengths)
    full = [cost[s] for s in filled if filled[s] == 2048]
    assert max(full) <= 2 * 1024**2 and min(full) >= 0.5 * max(full)  # uncut pieces of 2048 would cost 4 * 1024**2
    assert all(v & (v - 1) == 0 for v in filled.values())
    assert packing.room_for(5000, 2048) == [2048, 2048, 512, 256, 128, 8]
    assert packing.assign([], 2048) == []


def strange_texts(n, seed=3):
    rng = random.Random(seed)
    letters = [chr(c) for c in range(0x250)] + list("αΩσς\u0301\u0308中あ🙂\u2028\u3000\ud7a3\u0130ﬁ<|>'")
    plain = list("abcde fgh   's 'll <|endoftext|>\n\t.,")
    return ["".join(rng.choice(letters if rng.random() < 0.4 else plain) for _ in range(rng.randint(0, 24))) for _ in range(n)]


def test_word_ids_equal_the_library_on_all_characters():
    from tokenizers import Tokenizer

    tokenizer, words = Tokenizer.from_file(WORDS), packing.WordIds(WORDS)
    texts = [f"x{chr(c)}y {chr(c)}" for c in range(0x250)] + ["\x1b[31mred\x1b[0m x\x7fy", *strange_texts(20_000)]
    for text in texts:
        got = np.frombuffer(words.encode(text), "<i4").tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_byte_ids_equal_the_library_on_all_characters():
    _, memo, split = bpe._loaded(RANKS, BYTE_PATTERN)
    enc = reference()
    for text in strange_texts(20_000, 5):
        got = np.frombuffer(b"".join(map(memo.__getitem__, split(text))), "<u4").tolist()
        assert got == enc.encode_ordinary(text), repr(text)


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 5, "z")], "doc_id long, text string, length int, key string")
    assert sum(r["length"] for r in packing.pack(docs, WORDS).collect()) == 3
    assert bpe.encode(docs, RANKS, BYTE_PATTERN).first()["doc_id"] == 1


def test_words_of_latin_letters_and_few_memos():
    """Pieces by the standard ``re`` are those of the pattern; a full memo of pieces becomes the older half."""
    import re

    import public_tokenizers
    import regex

    from colophon.llm import packing

    words = [f"{a}{chr(c)}{b}" for c in range(33, 0x250) if chr(c).isprintable() for a, b in (("", ""), ("a", "b"), ("1", "'s"), ("-", "x2"))]
    find, given = re.compile(packing.latin_pieces()).findall, regex.compile(packing.PIECES).findall
    assert [find(w.lower()) for w in words] == [given(w.lower()) for w in words]
    ids = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"), most=64)
    first = ids.encode(" ".join(words))
    assert len(ids.older_pieces) == 64 and len(ids.of_piece) <= 64
    assert first == ids.encode(" ".join(words))
    whole = ids.tokenizer.encode(" ".join(words), add_special_tokens=False).ids
    assert first == b"".join(i.to_bytes(4, "little") for i in whole)
