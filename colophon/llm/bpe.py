"""Byte-level BPE by longest matches and backtracking, exact and linear in the text.

A piece of text (one match of the split pattern) is mapped to Latin-1, so that an Aho-Corasick
automaton over the vocabulary works on bytes. The encoder takes the longest token at a position
and goes on if it is compatible with the token before it; else it tries the next shorter prefix,
and steps back where none is left. Two tokens are compatible if merging their joined bytes gives
just the two again; a sequence is what the merges give exactly if all its neighbours are
compatible. Compatibility is memoised, and a position from which no way led on is not tried again.

Defined results: a null or empty text has no ids and decodes to no bytes; rows are encoded one by
one, so ties and repeated rows need no rule; only the id column and the outputs asked for return.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache, lru_cache
from hashlib import sha256

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEVER = 1 << 62
OUTPUTS = {
    "ids": "array<int>",
    "n_tokens": "long",
    "ids_sha256": "string",
    "decoded": "binary",
    "decoded_sha256": "string",
}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks, one pair a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class ByteBpe:
    """Encoder and decoder for one vocabulary. The rank of a token is its id."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        self.bytes_of = {i: token for token, i in ranks.items()}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, i in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.compatible = lru_cache(maxsize=1 << 20)(self._compatible)
        self.shorter = cache(self._shorter)  # this and what follows: a value a token at most
        self.parts = cache(self._parts)
        self.edges = cache(self._edges)

    def _parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge joins to ``token``; none for a single byte."""
        units = [self.bytes_of[token][i : i + 1] for i in range(len(self.bytes_of[token]))]
        while len(units) > 2:
            found = [(self.ranks.get(a + b, NEVER), k) for k, (a, b) in enumerate(zip(units, units[1:]))]
            rank, k = min(found)
            if rank >= token:
                return None  # no merges lead to it
            units[k : k + 2] = [units[k] + units[k + 1]]
        return (self.ranks[units[0]], self.ranks[units[1]]) if len(units) == 2 else None

    def _edges(self, token: int, side: int) -> tuple[int, ...]:
        """What stands at the left (0) or right (1) end of ``token`` while it is merged, byte first."""
        chain = [token]
        while (parts := self.parts(chain[-1])) is not None:
            chain.append(parts[side])
        return tuple(reversed(chain))

    def _compatible(self, left: int, right: int) -> bool:
        """Whether no merge across the border comes before those that end either side's state."""
        lefts, rights = self.edges(left, 1), self.edges(right, 0)
        i = j = 0
        while True:
            across = self.ranks.get(self.bytes_of[lefts[i]] + self.bytes_of[rights[j]], NEVER)
            next_left = lefts[i + 1] if i + 1 < len(lefts) else NEVER
            next_right = rights[j + 1] if j + 1 < len(rights) else NEVER
            if across < next_left and across <= next_right:
                return False
            if next_left == next_right == NEVER:
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1

    def _shorter(self, token: int) -> int | None:
        """The longest token that is a proper prefix of ``token``."""
        whole = self.bytes_of[token]
        return next((self.ranks[whole[:n]] for n in range(len(whole) - 1, 0, -1) if whole[:n] in self.ranks), None)

    def encode_piece(self, piece: bytes) -> list[int]:
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        text = piece.decode("latin-1")
        greedy = [token for _, token in self.automaton.iter_long(text)]
        if all(map(self.compatible, greedy, greedy[1:])):
            return greedy
        out: list[int] = []
        blocked: set[int] = set()
        at, token = 0, greedy[0]
        while at < len(piece):
            if token is None:  # nothing leads on from here
                if not out:
                    raise ValueError("the vocabulary lacks a byte")
                blocked.add(at)
                at -= len(self.bytes_of[out[-1]])
                token = self.shorter(out.pop())
                continue
            end = at + len(self.bytes_of[token])
            if end not in blocked and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                token = next(self.automaton.iter_long(text, at))[1] if at < len(piece) else None
            else:
                token = self.shorter(token)
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class PieceMemo(dict):
    """Little-endian 32-bit ids of a piece by its text.

    Memory is bounded: when full, it becomes the older half, whose entries come back on use.
    """

    def __init__(self, bpe: ByteBpe, most: int = 1 << 18):
        super().__init__()
        self.bpe, self.most, self.older = bpe, most, {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        if (found := self.older.get(piece)) is None:
            found = b"".join([i.to_bytes(4, "little") for i in self.bpe.encode_piece(piece.encode())])
        if len(piece) <= 64:
            self[piece] = found
        return found


@lru_cache(maxsize=2)
def _loaded(path: str, pattern: str):
    import regex

    bpe = ByteBpe(read_ranks(path))
    return bpe, PieceMemo(bpe), regex.compile(pattern).findall


def encode(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    outputs: tuple[str, ...] = ("ids",),
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The ids of every text and what is made of them: any of ``OUTPUTS``.

    ``decoded`` comes from the ids alone. ``vocabulary`` is the rank file's path on every machine.
    """
    chosen = tuple(outputs)
    rows = docs.select(F.col(f"`{id_column}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    schema = f"key {rows.schema['key'].dataType.simpleString()}, " + ", ".join(f"{c} {OUTPUTS[c]}" for c in chosen)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        bpe, memo, split = _loaded(vocabulary, pattern)
        types = {"ids": pa.list_(pa.int32()), "n_tokens": pa.int64(), "decoded": pa.binary()}
        for batch in batches:
            made: dict[str, list] = {c: [] for c in chosen}
            for value in batch.column(1):
                blob = b"".join(map(memo.__getitem__, split(value.as_py())))
                decoded = bpe.decode(np.frombuffer(blob, "<u4").tolist()) if any("decoded" in c for c in chosen) else b""
                for c in chosen:
                    made[c].append(
                        np.frombuffer(blob, "<i4")
                        if c == "ids"
                        else len(blob) // 4
                        if c == "n_tokens"
                        else sha256(blob).hexdigest()
                        if c == "ids_sha256"
                        else decoded
                        if c == "decoded"
                        else sha256(decoded).hexdigest()
                    )
            columns = [batch.column(0), *(pa.array(made[c], types.get(c, pa.string())) for c in chosen)]
            yield pa.RecordBatch.from_arrays(columns, ["key", *chosen])

    return rows.mapInArrow(run, schema).withColumnRenamed("key", id_column)


def decode(encoded: DataFrame, vocabulary: str, id_column: str = "doc_id", ids: str = "ids") -> DataFrame:
    """The bytes (``decoded``) of every row's ids; null ids give no bytes."""
    rows = encoded.select(F.col(f"`{id_column}`").alias("key"), F.coalesce(F.col(f"`{ids}`"), F.array().cast("array<int>")).alias("ids"))
    schema = f"key {rows.schema['key'].dataType.simpleString()}, decoded binary"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bpe = _loaded(vocabulary, "")[0]
        for batch in batches:
            made = pa.array([bpe.decode(x.as_py()) for x in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), made], ["key", "decoded"])

    return rows.mapInArrow(run, schema).withColumnRenamed("key", id_column)
