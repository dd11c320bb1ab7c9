"""Removal of repeated passages by suffix order over a prefix-free parsing.

A byte goes if a string of ``length`` bytes that covers it also starts in a document of smaller id.
The order of the corpus's suffixes, to the depth of ``length``, puts equal strings next to each
other. It is made from a prefix-free parsing: triggers, where a rolling hash is 0 modulo a period,
cut the text into phrases that reach ``length - 1`` bytes into the next one, so that every string
lies in one phrase; distinct phrases form the dictionary; ranks of the dictionary's suffixes, by
doubling, are carried through the parse (which phrase stands where) to the places in the corpus.
Repetitive text costs as much as its dictionary.

The corpus is spread over blocks of documents, and strings are dealt out by content: of the
rolling hashes inside a string the least one is its anchor, so equal strings have equal anchors.

0. A document with the text of a smaller id goes whole, and takes no part in what follows.
1. Every block reports its anchors; those of one document only need no further look.
2. Every block orders the strings at the other anchors and keeps the first document of each. What
   later documents of the block repeat is removed; the first one's strings go, by anchor, on.
3. For each share of the anchors the strings of all blocks are ordered once more, and every block
   is told which of its strings a smaller id has.
4. Every block removes the bytes.

A string reaches stage 3 once for each block however often the block holds it, so frequent
passages don't pile up in one task. What goes between blocks and shares are plain rows, one for an
anchor, a run of strings or a span, so their number follows the input however many blocks there
are. Only the digests of repeated texts are checkpointed; a lost executor's work is redone from the
input or from shuffle files.

Defined results: a null text counts as empty and returns as it was; texts shorter than ``length``
are kept; rows with equal ids don't remove each other's bytes; a null id comes before all
others; a text longer than a block makes a block that is longer; only the id, the columns asked for
and the outputs return, so other columns can't clash; an empty table gives an empty result.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.llm.common import ensure_checkpoint_dir, text_bytes

GRAM = 20
_RANDOM = np.random.default_rng(19820609)
_BYTE = _RANDOM.integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0xD6E8FEB86659FD93
_POWERS: list[np.ndarray] = []
#: A block's bytes: the least, and the most beyond ``FEW_BLOCKS``, so that a passage that all blocks have stays small.
BLOCK_BYTES, MOST_BLOCK_BYTES = 4 << 20, 32 << 20
#: Bytes that are hashed at once.
CHUNK = 1 << 19
LEAST_BLOCKS, FEW_BLOCKS = 64, 1 << 13
NULL_ID = -(1 << 63)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes from each place on."""
    n = len(data)
    if not _POWERS or len(_POWERS[0]) <= n:
        _POWERS.clear()
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            out = np.full(max(n, CHUNK + 64) + 1, base, np.uint64)
            out[0] = 1
            _POWERS.append(np.multiply.accumulate(out))
    up, down = _POWERS
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
    return _mixed((sums[width:] - sums[:-width]) * down[: n + 1 - width])


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` values from each place on."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (width - have)], values[width - have :]) if have < width else values


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[k], starts[k] + 1, ...``, ``counts[k]`` of them, for each ``k``."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + counts, counts)


def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.uint64)


def suffix_ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of the string of ``length`` bytes at each place of ``data`` where one fits."""
    n = len(data) - length + 1
    have = 1
    words = data.astype(np.uint64)
    while have < 8 and 2 * have <= length:
        words = words[:-have] << np.uint64(8 * have) | words[have:]
        have *= 2
    ranks = _ranks(words)
    while have < length:
        step = min(have, length - have)
        ranks = _ranks(ranks[:-step] << np.uint64(32) | ranks[step:])
        have += step
    return ranks[:n]


def corpus_ranks(data: np.ndarray, begins: np.ndarray, counts: np.ndarray, length: int, period: int = 512) -> np.ndarray:
    """Ranks of all strings of segments; equal strings have equal ranks.

    Segment ``k`` holds ``counts[k]`` strings; its text starts at ``begins[k]`` and goes on for
    ``length - 1`` bytes after the last string's start.
    """
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.uint64)
    width = min(16, length)
    trigger = np.zeros(len(data) + 1, bool)
    for a in range(0, len(data) - width + 1, CHUNK):  # tables of powers stay with a worker, so they are kept small
        part = rolling(data[a : a + CHUNK + width - 1], width)
        trigger[a : a + len(part)] = part % np.uint64(period) == 0
    trigger[begins] = True
    owned = np.zeros(len(data) + 1, bool)  # where a string starts
    owned[_ranges(begins, counts)] = True
    cuts = np.flatnonzero(trigger & owned)
    segment = np.searchsorted(begins, cuts, side="right") - 1
    ends = np.append(cuts[1:], len(data))
    ends = np.minimum(ends, begins[segment] + counts[segment])
    raw = data.tobytes()
    dictionary: dict[bytes, int] = {}
    parse = np.fromiter(
        (dictionary.setdefault(raw[a:b], len(dictionary)) for a, b in zip(cuts.tolist(), (ends + length - 1).tolist())),
        np.int64,
        len(cuts),
    )
    phrases = list(dictionary)
    sizes = np.fromiter(map(len, phrases), np.int64, len(phrases))
    offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    ranks = suffix_ranks(np.frombuffer(b"".join(phrases), np.uint8), length)
    return ranks[_ranges(offsets[parse], ends - cuts)]


class Block:
    """The documents of a block in order of id, then text, as one run of bytes.

    ``notes`` names documents that are copies, as rows with ``id`` and ``digest``; their bytes are left out.
    """

    def __init__(self, rows, length: int, shares: int = 1, notes=None):
        self.length, self.shares = length, shares
        ids = rows.column("id").fill_null(NULL_ID).to_numpy()
        found = rows.column("data").to_pylist()
        texts = [t or b"" for t in found]
        self.order = sorted(range(len(texts)), key=lambda k: (ids[k], texts[k]))
        self.null = [found[k] is None for k in self.order]
        self.ids = np.array([ids[k] for k in self.order], np.int64)
        self.texts = [texts[k] for k in self.order]
        self.copies: list[tuple[int, int]] = []
        if notes is not None:
            named = {(i, d) for i, d in zip(notes.column("id").to_pylist(), notes.column("digest").to_pylist()) if d}
            known = {i for i, _ in named}
            for k, (i, text) in enumerate(zip(self.ids.tolist(), self.texts)):
                if i in known and (i, sha256(text).hexdigest()) in named:
                    self.copies.append((k, len(text)))
                    self.texts[k] = b""
        sizes = np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes

    def runs(self):
        """``(places, counts, anchors, rows)``: runs of strings with one anchor, a part at a time."""
        k = 0
        while k < len(self.texts):
            to = max(k + 1, int(np.searchsorted(self.ends, self.starts[k] + CHUNK, side="right")))
            base = self.starts[k]
            data = np.frombuffer(b"".join(self.texts[k:to]), np.uint8)
            if len(data) >= self.length:
                anchors = least_of(rolling(data, GRAM), self.length - GRAM + 1)
                here = np.arange(k, to)
                some = np.maximum(self.ends[k:to] - self.starts[k:to] - self.length + 1, 0)
                here, first, some = here[some > 0], (self.starts[k:to] - base)[some > 0], some[some > 0]
                places = _ranges(first, some)
                found, rows = anchors[places], np.repeat(here, some)
                if len(places):
                    new = np.ones(len(places), bool)
                    new[1:] = (found[1:] != found[:-1]) | (rows[1:] != rows[:-1])
                    at = np.flatnonzero(new)
                    yield places[at] + base, np.diff(np.append(at, len(places))), codes(found[at], self.shares), rows[at]
            k = to

    def all_runs(self):
        parts = list(self.runs())
        if not parts:
            return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
        return tuple(np.concatenate(p) for p in zip(*parts))


def codes(anchors: np.ndarray, shares: int) -> np.ndarray:
    """Anchors as the number of their share and 31 bits more, the lowest bit 0.

    Anchors of one code look shared where they aren't, which costs a comparison and changes nothing.
    """
    return (_mixed(anchors) % np.uint64(shares)) << np.uint64(32) | (anchors & np.uint64(0xFFFFFFFE))


ANCHORS = "share int, block int, anchor int"
NOTES = "block int, code long, id long, digest string"
STRINGS = "share int, block int, id long, row int, start int, count int, data binary"
SPANS = "block int, row int, start int, end int"


def _table(schema: str, columns: list):
    import pyarrow as pa

    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    n = max((len(c) for c in columns if hasattr(c, "__len__")), default=0)
    full = [c if hasattr(c, "__len__") else pa.nulls(n, kinds[k]) if c is None else np.full(n, c) for c, (_, k) in zip(columns, fields)]
    return pa.table({name: c if isinstance(c, pa.Array) else pa.array(c, kinds[k]) for c, (name, k) in zip(full, fields)})


def _slices(data: np.ndarray, sizes: np.ndarray):
    """An Arrow array of the consecutive slices of ``data``."""
    import pyarrow as pa

    ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def _joined(column) -> np.ndarray:
    """The bytes of a binary column without nulls, one value after the other."""
    import pyarrow as pa

    array = column.combine_chunks().cast(pa.large_binary())
    _, offsets, data = array.buffers()
    ends = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]


def report_anchors(block: int, rows, notes, length: int, shares: int):
    """Stage 1: distinct anchors; the lowest bit says whether two documents of the block have it."""
    held = Block(rows, length, shares, notes)
    _, _, anchors, at = held.all_runs()
    ids = held.ids[at] if len(at) else at
    order = np.lexsort((ids, anchors))
    anchors, ids = anchors[order], ids[order]
    first = np.ones(len(anchors), bool)
    first[1:] = anchors[1:] != anchors[:-1]
    several = np.zeros(len(anchors), bool)
    several[1:] = ~first[1:] & (ids[1:] != ids[:-1])
    group = np.cumsum(first) - 1
    flag = np.bincount(group, several, first.sum() if len(first) else 0) > 0
    keys = anchors[first] | flag.astype(np.uint64)
    return _table(ANCHORS, [(keys >> np.uint64(32)).astype(np.int32), block, keys.astype(np.uint32).view(np.int32)])


def match_anchors(share: int, rows):
    """Anchors that two documents have, for each block; the lowest bit says whether two blocks do."""
    rows = rows.combine_chunks()
    keys = rows.column("anchor").to_numpy().view(np.uint32).astype(np.uint64)
    owner = rows.column("block").to_numpy()
    plain = keys & ~np.uint64(1)
    order = np.argsort(plain, kind="stable")
    plain, owner, flag = plain[order], owner[order], (keys[order] & np.uint64(1)) > 0
    first = np.ones(len(plain), bool)
    first[1:] = plain[1:] != plain[:-1]
    group = np.cumsum(first) - 1
    far = (np.bincount(group) > 1)[group]
    take = far | flag
    code = np.uint64(share) << np.uint64(32) | plain[take] | far[take].astype(np.uint64)
    return _table(NOTES, [owner[take], code.view(np.int64), None, None])


def _removed(places: np.ndarray, rows: np.ndarray, gone: np.ndarray, length: int):
    """Rows, first and end bytes of the spans that strings marked ``gone`` cover."""
    places, rows = places[gone], rows[gone]
    if not len(places):
        return rows, places, places
    new = np.ones(len(places), bool)
    new[1:] = (places[1:] != places[:-1] + 1) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(places)) - 1
    return rows[at], places[at], places[last] + length


def order_block(block: int, rows, notes, length: int, shares: int):
    """Stage 2: spans to remove inside the block, and the first document's strings by anchor.

    Spans pass stage 3 in a share of the block's own, as rows without data whose count is the end.
    """
    import pyarrow as pa

    if not rows.num_rows:
        return _table(STRINGS, [[]] * 7)
    held = Block(rows, length, shares, notes)
    out = []

    def own(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        out.append(_table(STRINGS, [np.full(len(row), shares + block), block, 0, row, start, end, None]))

    if whole := [(k, n) for k, n in held.copies if n >= length]:
        row, end = np.array(whole, np.int64).T
        own(row, np.zeros_like(row), end)
    shared = np.sort(notes.column("code").drop_null().to_numpy().view(np.uint64))
    places, counts, anchors, at = held.all_runs()
    if len(shared):
        where = np.minimum(np.searchsorted(shared, anchors), len(shared) - 1)
        hit = (shared[where] & ~np.uint64(1)) == anchors
        places, counts, anchors, at = places[hit], counts[hit], anchors[hit], at[hit]
        far = (shared[where[hit]] & np.uint64(1)) > 0
    if not len(shared) or not len(places):
        return pa.concat_tables(out) if out else _table(STRINGS, [[]] * 7)
    # neighbouring runs of a document form a segment
    new = np.ones(len(places), bool)
    new[1:] = (places[1:] != places[:-1] + counts[:-1]) | (at[1:] != at[:-1])
    first = np.flatnonzero(new)
    many = np.add.reduceat(counts, first)
    whole = np.frombuffer(b"".join(held.texts), np.uint8)
    text = whole[_ranges(places[first], many + length - 1)]
    begins = np.cumsum(many + length - 1) - (many + length - 1)
    ranks = corpus_ranks(text, begins, many, length).astype(np.int64)
    string_at, string_row = _ranges(places, counts), np.repeat(at, counts)
    least = np.full(int(ranks.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, ranks, held.ids[string_row])
    gone = held.ids[string_row] > least[ranks]
    local = string_at - held.starts[string_row]
    row, start, end = _removed(local, string_row, gone, length)
    if len(row):
        own(row, start, end)
    send = np.flatnonzero(~gone & np.repeat(far, counts))
    if len(send):
        key = np.repeat(anchors, counts)[send]
        new = np.ones(len(send), bool)
        place, row = string_at[send], string_row[send]
        new[1:] = (place[1:] != place[:-1] + 1) | (key[1:] != key[:-1]) | (row[1:] != row[:-1])
        piece = np.flatnonzero(new)
        n = np.diff(np.append(piece, len(send)))
        head = send[piece]
        data = _slices(whole[_ranges(string_at[head], n + length - 1)], n + length - 1)
        share = (key[piece] >> np.uint64(32)).astype(np.int32)
        row = string_row[head]
        out.append(_table(STRINGS, [share, block, held.ids[row], row, local[head], n, data]))
    return pa.concat_tables(out) if out else _table(STRINGS, [[]] * 7)


def order_share(share: int, shares: int, rows, length: int):
    """Stage 3: spans to remove, for each block, among the strings of a share of the anchors."""
    rows = rows.combine_chunks()
    block, ids, row, start, n = (rows.column(c).to_numpy() for c in ("block", "id", "row", "start", "count"))
    if share >= shares:  # a block's own spans pass
        return _table(SPANS, [block, row, start, n])
    start, n = start.astype(np.int64), n.astype(np.int64)
    text = _joined(rows.column("data"))
    ranks = corpus_ranks(text, np.cumsum(n + length - 1) - (n + length - 1), n, length).astype(np.int64)
    least = np.full(int(ranks.max()) + 1, np.iinfo(np.int64).max)
    owner = np.repeat(np.arange(len(n)), n)
    np.minimum.at(least, ranks, ids[owner])
    gone = ids[owner] > least[ranks]
    piece, first, end = _removed(_ranges(start, n), owner, gone, length)
    return _table(SPANS, [block[piece], row[piece], first, end])


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(zip(starts.tolist(), ends.tolist())):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def spans_of(rows, spans, length: int):
    """Stage 4: the block, and the spans to remove for each of its documents."""
    held = Block(rows, length)
    if not spans.num_rows:
        return held, {}
    row, start, end = (spans.column(c).to_numpy().astype(np.int64) for c in ("row", "start", "end"))
    order = np.argsort(row, kind="stable")
    row, start, end = row[order], start[order], end[order]
    edges = np.flatnonzero(np.diff(row, prepend=-1, append=-1))
    return held, {int(row[a]): merged(start[a:b], end[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())}


OUTPUTS = {
    "n_bytes": "long",
    "n_removed": "long",
    "n_spans": "long",
    "kept_sha256": "string",
    "kept": "binary",
    "kept_text": "string",
    "spans": "array<struct<start: long, end: long>>",
}


def blocks_for(size: int) -> int:
    """Number of blocks for so many bytes of text."""
    return max(LEAST_BLOCKS, size // min(MOST_BLOCK_BYTES, max(BLOCK_BYTES, size // FEW_BLOCKS)) + 1)


def repeated_passages(
    docs: DataFrame,
    length: int = 50,
    outputs: tuple[str, ...] = ("n_bytes", "n_removed", "n_spans", "kept"),
    id_column: str = "doc_id",
    text: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """The id of every document, columns to ``carry`` along and any of ``OUTPUTS``.

    ``kept_text`` leaves out characters of which only some bytes stay, and is null for a null text.

    ``length`` is at least 20. The number of blocks follows the input.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    blocks = blocks_for(text_bytes(docs, f"`{text}`"))
    renamed = {f"x{k}": F.col(f"`{c}`") for k, c in enumerate(carry)}
    placed = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.encode(F.col(f"`{text}`"), "UTF-8").alias("data"),
        *[c.alias(k) for k, c in renamed.items()],
    )
    block = F.pmod(F.xxhash64("id", "data"), F.lit(blocks)).cast("int")  # rows of one id go to many
    placed = placed.select(block.alias("block"), *placed.columns)
    dealt = placed.repartition(blocks, "block")  # one exchange, read three times

    marked = placed.filter(F.octet_length("data") >= length).select("block", "id", F.sha2("data", 256).alias("digest"))
    firsts = marked.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = firsts.checkpoint()  # so that the join can split the copies of one text
    copies = marked.join(firsts, "digest").filter("id > first")
    copies = copies.select(F.col("block").alias("block"), F.lit(None).cast("long").alias("code"), F.col("id").alias("id"), "digest")

    def anchors(key, rows, notes):
        return report_anchors(key[0].as_py(), rows, notes, length, blocks)

    def strings(key, rows, notes):
        return order_block(key[0].as_py(), rows, notes, length, blocks)

    found = dealt.groupBy("block").cogroup(copies.groupBy("block")).applyInArrow(anchors, ANCHORS)
    notes = found.groupBy("share").applyInArrow(lambda key, rows: match_anchors(key[0].as_py(), rows), NOTES).unionByName(copies)
    sent = dealt.groupBy("block").cogroup(notes.groupBy("block")).applyInArrow(strings, STRINGS)
    spans = sent.groupBy("share").applyInArrow(lambda key, rows: order_share(key[0].as_py(), blocks, rows, length), SPANS)

    extra = tuple(renamed)
    carried = [f"{k} {placed.schema[k].dataType.simpleString()}" for k in extra]
    schema = ", ".join(["id long", *carried, *(f"{c} {OUTPUTS[c]}" for c in outputs)])

    def cut(rows, found):
        import pyarrow as pa

        held, gone = spans_of(rows, found, length)
        made: dict[str, list] = {c: [] for c in outputs}
        for k, data in enumerate(held.texts):
            mine = gone.get(k, [])
            inner = [0, *(x for span in mine for x in span), len(data)]
            parts = [data[a:b] for a, b in zip(inner[::2], inner[1::2])] if mine else [data]
            kept = b"".join(parts)
            for c in outputs:
                made[c].append(
                    len(data)
                    if c == "n_bytes"
                    else len(data) - len(kept)
                    if c == "n_removed"
                    else len(mine)
                    if c == "n_spans"
                    else sha256(kept).hexdigest()
                    if c == "kept_sha256"
                    else kept
                    if c == "kept"
                    else (None if held.null[k] else "".join([x.decode("utf-8", "ignore") for x in parts]))
                    if c == "kept_text"
                    else [{"start": a, "end": b} for a, b in mine]
                )
        kinds = {"kept_sha256": pa.string(), "kept": pa.binary(), "kept_text": pa.string()}
        kinds["spans"] = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        order = pa.array(held.order, pa.int64())
        columns = {c: rows.column(c).take(order) for c in ("id", *extra)}
        return pa.table(columns | {c: pa.array(made[c], kinds.get(c, pa.int64())) for c in outputs})

    out = dealt.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(cut, schema)
    return out.toDF(id_column, *carry, *outputs)
