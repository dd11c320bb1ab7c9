"""Cost-balanced packing of documents into training sequences.

Documents are tokenized and packed where they are read, so no text is shuffled. Each task works in
windows of a bounded number of tokens. A document is cut into pieces of at most half a sequence, so
that no single piece makes a sequence dear; pieces are assigned in descending length to the
sequence of lowest estimated cost (linear plus quadratic in the lengths of its pieces, as attention
costs) with remaining capacity for them. A piece that fits nowhere whole is cut over the cheapest
open sequences. A window's last tokens get sequences of power-of-two lengths, which need no
padding, so every sequence is filled.

Defined results: a null or empty text is the end token alone; equal documents are packed one by
one; a very long text is encoded whole and fills a window of its own; ties go by order of input; an
empty table gives no pieces; only the id column and the piece's columns return, so other columns
can't clash. Sequence ids hold the task's number, so they are unique and don't change when a
task runs again on the same input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import category, is_normalized
from zlib import crc32

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


#: Splits a lower-cased word before the merges; a fixed value of the tokenizer file.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def latin_pieces() -> str:
    """``PIECES`` for lower-cased words of printable characters below U+0250, without a class that the standard ``re`` lacks."""
    letters = sorted({c for k in range(0x250) for c in chr(k) + chr(k).lower()})  # two have a lower case far above
    held = {k: "".join(re.escape(c) for c in letters if category(c)[0] == k) for k in "LN"}
    return rf"'s|'t|'re|'ve|'m|'ll|'d|[{held['L']}]+|[{held['N']}]|[^ {held['L']}{held['N']}]+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes stand for
    themselves, the others for the letters from U+0100 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


class WordIds(dict):
    """Token ids of words as little-endian 32-bit bytes.

    The tokenizer drops white space and never merges across it, so words can be encoded apart.
    Words of printable ASCII characters and Latin letters in composed form go straight to the merges,
    any other word (control characters too) to the whole tokenizer. Memory is bounded: when full, it becomes the older half,
    whose entries come back on use; so do the pieces of words.
    """

    def __init__(self, path: str, most: int = 1 << 18):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.most, self.older = Tokenizer.from_file(path), most, {}
        self.merged, self.letters = self.tokenizer.model.tokenize, byte_letters()
        self.pieces, self.of_piece, self.older_pieces = re.compile(latin_pieces()).findall, {}, {}

    def piece(self, piece: str) -> bytes:
        if (found := self.of_piece.get(piece)) is None:
            if len(self.of_piece) >= self.most:
                self.older_pieces, self.of_piece = self.of_piece, {}
            if (found := self.older_pieces.get(piece)) is None:
                text = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
                found = b"".join([t.id.to_bytes(4, "little") for t in self.merged(text)])
            self.of_piece[piece] = found
        return found

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        if (found := self.older.get(word)) is None:
            latin = word.isprintable() and (word.isascii() or (max(word) < "\u0250" and is_normalized("NFC", word)))
            if latin and "<|" not in word:
                low = word.lower()
                found = self.piece(low) if low.isalpha() else b"".join(map(self.piece, self.pieces(low)))
            else:
                ids = self.tokenizer.encode(word, add_special_tokens=False).ids
                found = b"".join([i.to_bytes(4, "little") for i in ids])
        if len(word) <= 64:
            self[word] = found
        return found

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").replace("\t", " ").split(" ")))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def room_for(total: int, capacity: int) -> list[int]:
    """Lengths of the sequences that ``total`` tokens fill: full ones, then powers of two."""
    rooms = [capacity] * (total // capacity)
    rest = total % capacity
    return rooms + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


def assign(lengths: list[int], capacity: int, linear: float = 1.0, quadratic: float = 1 / 512, most: int | None = None):
    """``(item, start, length, sequence, offset)`` of pieces that fill ``room_for(sum(lengths))``.

    ``most``: length of a piece, by default half of ``capacity``.
    """
    import numpy as np

    most = most or max(1, capacity // 2)
    cuts = [(min(most, n - start), item, start) for item, n in enumerate(lengths) for start in range(0, n, most)]
    rooms = np.array(room_for(sum(lengths), capacity), np.int64)
    left, cost = rooms.copy(), np.zeros(len(rooms))
    out = []
    for n, item, start in sorted(cuts, key=lambda c: (-c[0], c[1:])):
        while n:
            fits = left >= n
            some = fits if fits.any() else left > 0
            s = int(np.where(some, cost, np.inf).argmin())
            take = min(n, int(left[s]))
            out.append((item, start, take, s, int(rooms[s] - left[s])))
            left[s] -= take
            cost[s] += linear * take + quadratic * take * take
            start, n = start + take, n - take
    return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 1,
    window_tokens: int = 1 << 21,
    with_ids: bool = False,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """A row for each piece: document, place in it, CRC of its ids, sequence and offset there.

    ``with_ids`` adds the ids themselves. ``tokenizer`` is the file's path on every machine.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    schema = f"key {rows.schema['key'].dataType.simpleString()}, {PIECE}" + ", ids array<int>" * with_ids
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        words = word_ids(tokenizer)
        sequence = TaskContext.get().partitionId() << 40

        def packed(keys: list, blobs: list[bytes]):
            nonlocal sequence
            lengths = [len(b) // 4 for b in blobs]
            pieces = assign(lengths, capacity)
            item, start, length, s, offset = (list(x) for x in zip(*pieces))
            cut = [blobs[i][4 * a : 4 * (a + n)] for i, a, n in zip(item, start, length)]
            columns = {
                "key": pa.concat_arrays(keys).take(pa.array(item)),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array([crc32(c) for c in cut], pa.int64()),
                "doc_tokens": pa.array([lengths[i] for i in item], pa.int64()),
                "sequence_id": pa.array([sequence + x for x in s], pa.int64()),
                "offset": pa.array(offset, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array([np.frombuffer(c, "<i4") for c in cut], pa.list_(pa.int32()))
            sequence += max(s) + 1
            return pa.RecordBatch.from_pydict(columns)

        keys, blobs, held = [], [], 0
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                found = [words.encode(t) + end for t in part.column(1).to_pylist()]
                keys.append(part.column(0))
                blobs += found
                held += sum(map(len, found)) // 4
                if held >= window_tokens:
                    yield packed(keys, blobs)
                    keys, blobs, held = [], [], 0
        if blobs:
            yield packed(keys, blobs)

    return rows.mapInArrow(run, schema).withColumnRenamed("key", id_column)
