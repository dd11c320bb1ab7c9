"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document is the set of its distinct word shingles, as 64-bit hashes. A sketch has ``bands *
rows`` bins. In round ``i`` every shingle is hashed to a bin and a value; a bin keeps the least
(round, value) it gets, so later rounds only fill what earlier ones left empty. The first half of
the rounds picks random bins, the second half sends every shingle to the round's own bin, so all
bins are filled. Two documents agree in a bin with the probability of their Jaccard similarity.
With 24 bands of 4 rows a pair at 0.8 shares a band but for 3 in a million.

Documents of one shingle set are one class, so exact copies meet once, and buckets of the same
members are one. No pair leaves a task: tasks hold some members of a bucket, compare all of them
and send on the least member that each is connected to. This is done twice. Sketches first: two
members are likely if their sketches agree in so many bins that a true pair has fewer with a
probability under one in a million. What is connected by likely pairs is a family. Then each family
is compared on the full sets.

A large bucket or family is split into blocks, each with the same few leaders. Blocks are compared
by themselves first, so what is alike is connected at a cost in proportion to its size. Only the
members outside the largest component then meet all the others, in pairs of blocks. Every pair that
shares a band thus is compared, or connected already. That last step costs the number of such
members times the size of their family: documents that are alike, but not quite enough.

A full set is a set of 64-bit hashes of shingles of 64-bit hashes of words: of a corpus with ``n``
distinct shingles a share of ``n / 2 ** 64`` has the hash of another one.

Defined results: null and empty texts and texts without words have an empty set, which is linked
with nothing; equal texts are copies of each other, and so are repeated rows; every row without an
id is a document of its own, numbered after the largest id in the order of the texts, and is
compared like any other; so is every row whose id already names another text (the text of the
least hash keeps the id); the smallest number stands for a component, so one with an id goes before
those without; very long texts are hashed whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b
from itertools import combinations
from math import comb, log

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.llm.common import ensure_checkpoint_dir
from colophon.llm.graph import components, least_reached
from colophon.operators.ingest import number_rows

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_CHUNK = 1 << 18


def mixed(x: np.ndarray) -> np.ndarray:
    """A well mixed permutation of 64-bit numbers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie one after the other from ``starts``; their first bytes."""
    solid = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[starts] = True
    begin = solid.copy()
    begin[1:] &= ~solid[:-1] | first[1:-1]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | first[1:-1]
    begins, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=sums[1:])
    return mixed((sums[ends] - sums[begins]) * powers(_BASE_INVERSE, len(data))[begins]), begins


def shingle_sets(texts, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of an Arrow string array without nulls."""
    import pyarrow as pa

    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _CHUNK)) - 1)
        to = min(to, len(texts))
        base = offsets[at]
        part, starts = data[base : offsets[to]], offsets[at:to] - base
        hashes, begins = word_hashes(part, starts[starts < len(part)]) if len(part) else (np.zeros(0, np.uint64),) * 2
        edges = np.append(np.searchsorted(begins, starts), len(begins))
        n = max(0, len(hashes) - words + 1)
        joined = np.full(n, words, np.uint64)
        for k in range(words):
            joined = mixed(joined + hashes[k : k + n])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if b - a >= words:
                yield np.unique(joined[a : b - words + 1])
            elif b == a:
                yield np.zeros(0, np.uint64)
            else:
                one = np.full(1, b - a, np.uint64)
                for k in range(a, b):
                    one = mixed(one + hashes[k])
                yield one
        at = to


def sketch(shingles: np.ndarray, bins: int) -> np.ndarray:
    """One (round, value) number for each bin; ``shingles`` must not be empty."""
    never = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(bins, never)
    done = 0
    while done < 2 * bins:
        count = min(max(1, 3 * bins // len(shingles)), (bins if done < bins else 2 * bins) - done)
        rounds = np.arange(done, done + count, dtype=np.uint64)
        values = mixed(shingles[None, :] ^ mixed(rounds + np.uint64(1))[:, None])
        ranked = (rounds[:, None] << np.uint64(48)) | (values >> np.uint64(16))
        if done < bins:
            # of the low bits, which the kept value doesn't hold
            chosen = ((values & np.uint64(0xFFFF)) * np.uint64(bins)) >> np.uint64(16)
            order = np.argsort(ranked, axis=None)[::-1]  # the least comes last and stays
            best = np.full(bins, never)
            best[chosen.ravel()[order].astype(np.int64)] = ranked.ravel()[order]
        else:
            best = np.full(bins, never)
            best[(rounds - np.uint64(bins)).astype(np.int64)] = ranked.min(axis=1)
        out = np.minimum(out, best)
        done += count
        if out.max() != never:
            break
    return out


def band_keys(values: np.ndarray, bands: int) -> np.ndarray:
    keys = mixed(np.arange(1, bands + 1, dtype=np.uint64))
    for column in values.reshape(bands, -1).T:
        keys = mixed(keys + column)
    return keys.view(np.int64)


def signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """``(id, n, class, keys, bins)``; the class names the shingle set and is null for the empty one.

    ``bins`` has 16 bits of each bin's value.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sizes, classes, keys, bins = [], [], [], []
            for shingles in shingle_sets(batch.column(1), words):
                sizes.append(len(shingles))
                classes.append(blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
                values = sketch(shingles, bands * rows) if len(shingles) else None
                keys.append(None if values is None else band_keys(values, bands))
                bins.append(None if values is None else mixed(values).astype(np.uint16).view(np.int16))
            columns = [pa.array(sizes, pa.int64()), pa.array(classes, pa.binary())]
            columns += [pa.array(keys, pa.list_(pa.int64())), pa.array(bins, pa.list_(pa.int16()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "n", "class", "keys", "bins"])

    return docs.mapInArrow(run, "id long, n long, class binary, keys array<long>, bins array<smallint>")


def sets_of(docs: DataFrame, words: int) -> DataFrame:
    """``(id, shingles)``."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            made = [s.view(np.int64) for s in shingle_sets(batch.column(1), words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.int64()))], ["id", "shingles"])

    return docs.mapInArrow(run, "id long, shingles array<long>")


#: Up to so many ids (eight bytes each) are broadcast; more are joined by shuffling the texts.
BROADCAST_IDS = 1 << 20
#: Members of a block and shingles that a block's members have together.
BLOCK_ROWS, BLOCK_SHINGLES = 512, 1 << 20
LEADERS = 4
#: Columns of shingles that at most so many sets hold are counted pair by pair, others by products.
SPARSE = 8


def only_ids(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """Texts of the ``ids``, which are distinct and checkpointed."""
    small = ids.count() <= BROADCAST_IDS
    return texts.join(F.broadcast(ids) if small else ids, "id", "left_semi")


def shared_buckets(entries: DataFrame) -> DataFrame:
    """``(group, rep)`` of buckets with two members or more, once for each set of members."""
    buckets = entries.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("rep")).alias("set"))
    buckets = buckets.filter("size > 1").groupBy("size", "set").agg(F.min("key").alias("key"))
    return entries.join(buckets.select("key"), "key").select(F.col("key").alias("group"), "rep")


def fewest_agreeing(bins: int, percent: int, miss: float = 1e-6) -> int:
    """So many bins agree for a pair at ``percent``, but for a share of at most ``miss``."""
    p, below, k = percent / 100, 0.0, 0
    while below + (now := comb(bins, k) * p**k * (1 - p) ** (bins - k)) <= miss:
        below, k = below + now, k + 1
    return k


def bands_for(percent: int, rows: int, miss: float = 4e-6) -> int:
    """Bands of ``rows`` of which a pair at ``percent`` shares none but for a share of ``miss``."""
    return max(1, round(log(miss) / log(1 - (percent / 100) ** rows)))


def likely_pairs(rows, percent: int) -> np.ndarray:
    """Which of the members may be ``percent`` alike, by sizes and sketches."""
    n = rows.column("n").to_numpy()
    bins = np.stack(rows.column("bins").to_numpy(zero_copy_only=False))
    agree = np.zeros((len(n), len(n)), np.uint16)
    for column in bins.T:
        agree += column[:, None] == column
    sizes = 100 * np.minimum(n[:, None], n) >= percent * np.maximum(n[:, None], n)
    return sizes & (agree >= fewest_agreeing(bins.shape[1], percent))


def linked_pairs(rows, percent: int) -> np.ndarray:
    """Which of the members are ``percent`` alike or more, by their full sets."""
    sets = rows.column("shingles").to_numpy(zero_copy_only=False)
    n = np.array([len(s) for s in sets], np.int64)
    m = len(sets)
    if m == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.full((2, 2), 100 * common >= percent * (n.sum() - common))
    common = np.zeros((m, m), np.float32 if n.max() < 1 << 24 else np.float64)
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")  # owners ascend within a column
    owner, held_by = np.repeat(np.arange(m), n)[order], held[column[order]]
    for k in range(2, SPARSE + 1):
        of = owner[held_by == k].reshape(-1, k)
        if len(of):
            pairs = np.concatenate([of[:, i] * m + of[:, j] for i, j in combinations(range(k), 2)])
            common += np.bincount(pairs, minlength=m * m).reshape(m, m)
    common += common.T.copy()
    owner, sizes = owner[held_by > SPARSE], held[held > SPARSE]
    ends = np.append(0, np.cumsum(sizes))
    for a in range(0, len(sizes), 2048):
        b = min(a + 2048, len(sizes))
        part = np.zeros((m, b - a), common.dtype)
        part[owner[ends[a] : ends[b]], np.repeat(np.arange(b - a), sizes[a:b])] = 1
        common += part @ part.T
    out = np.zeros((m, m), bool)
    for a in range(0, m, 256):
        here = common[a : a + 256].astype(float)
        out[a : a + 256] = 100 * here >= percent * (n[a : a + 256, None] + n - here)
    return out


def connected(units: DataFrame, alike: Callable, most: int) -> DataFrame:
    """``(rep, least)``: the least member of its unit that each is connected to, if it is another one.

    ``units`` has ``unit``, ``rep``, ``weight`` and what ``alike`` reads. Groups get whole units of
    together about ``most`` of weight, or less where there would be fewer groups than partitions.
    """

    def run(table):
        import pyarrow as pa

        table = table.sort_by([("unit", "ascending"), ("rep", "ascending")]).combine_chunks()
        unit, reps = table.column("unit").to_numpy(), table.column("rep").to_numpy()
        new = np.ones(len(unit), bool)  # a member may stand on both sides
        new[1:] = (unit[1:] != unit[:-1]) | (reps[1:] != reps[:-1])
        if not new.all():
            table, unit, reps = table.filter(pa.array(new)).combine_chunks(), unit[new], reps[new]
        edges = np.flatnonzero(np.append(np.append(True, unit[1:] != unit[:-1]), True))
        ends = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if b - a > 1:
                least = least_reached(alike(table.slice(a, b - a)))
                some = np.flatnonzero(least != np.arange(b - a))
                ends.append((reps[a:b][some], reps[a:b][least[some]]))
        reps, least = (np.concatenate(x) for x in zip(*ends))
        return pa.table({"rep": reps, "least": least})

    units = units.checkpoint()
    total = units.agg(F.sum("weight").alias("n")).first()["n"] or 0
    count = max(total // most + 1, int(units.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = units.withColumn("part", F.pmod(F.xxhash64("unit"), F.lit(count)))
    return parts.groupBy("part").applyInArrow(run, "rep long, least long").checkpoint()


def family_labels(members: DataFrame, data: DataFrame, alike: Callable, most: int, block_rows: int) -> DataFrame:
    """``(node, component)`` of all members that ``alike`` pairs of a group connect.

    ``members`` has ``group`` and ``rep``; ``data`` a row for each ``rep``, with its ``weight``.
    """

    def blocks(rows: DataFrame, name: str, *more: Column) -> DataFrame:
        count = F.greatest(F.ceil(F.count(F.lit(1)) / block_rows), F.ceil(F.sum("weight") / most)).cast("int")
        return rows.groupBy("group").agg(count.alias(name), *more)

    def block(count: str) -> Column:
        return F.pmod(F.xxhash64("rep", F.lit(count)), F.col(count)).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    # counts of groups are fixed before they are joined, so that a join can split the rows of one
    weighed = members.join(data.select("rep", "weight"), "rep").checkpoint()
    heads = F.array(*[F.min_by("rep", F.xxhash64("rep", F.lit(k))) for k in range(LEADERS)])
    sizes = blocks(weighed, "all", heads.alias("heads")).checkpoint()
    placed = weighed.join(sizes, "group").checkpoint()
    split = placed.filter("all > 1")
    led = sizes.filter("all > 1").select("group", F.explode("heads").alias("rep"), "all")
    led = led.select("rep", "group", every("all").alias("at"))
    first = placed.select("rep", "group", block("all").alias("at")).unionByName(led)
    first = first.select("rep", F.xxhash64("group", "at").alias("unit"))
    found = connected(first.join(data, "rep"), alike, most)
    labels = components(found, "rep", "least")
    if split.isEmpty():
        return labels
    named = split.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.withColumn("label", F.coalesce("component", "rep")).select("group", "rep", "weight", "all", "label").checkpoint()
    parts = named.groupBy("group", "label").agg(F.count(F.lit(1)).alias("part"))
    largest = parts.groupBy("group").agg(F.max_by("label", F.struct("part", "label")).alias("largest")).checkpoint()
    outside = named.join(largest, "group").filter("label <> largest").drop("largest").checkpoint()
    if outside.isEmpty():
        return labels
    counts = blocks(outside, "out").checkpoint()
    outside, against = outside.join(counts, "group"), named.join(counts, "group")
    left = outside.select("rep", "group", block("out").alias("o"), every("all").alias("a"))
    right = against.select("rep", "group", every("out").alias("o"), block("all").alias("a"))
    second = left.unionByName(right).select("rep", F.xxhash64("group", "o", "a").alias("unit"))
    found = found.unionByName(connected(second.join(data, "rep"), alike, most))
    return components(found, "rep", "least")


def numbered(docs: DataFrame, id_column: str, text: str) -> tuple[DataFrame, int | None]:
    """``docs`` with ``_row``: the id, or a number of its own for a row without one or whose id names
    another text; the first such number.

    Such rows are written to the shared folder once, so that their numbers stay the same.
    """
    key, digest = F.col(f"`{id_column}`").cast("long"), F.xxhash64(F.col(f"`{text}`"))
    texts = docs.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("n"), F.min(digest).alias("_own"), F.max(digest).alias("other"))
    several = F.col("_key").isNotNull() & (F.col("_own") != F.col("other"))
    taken = texts.filter(several).select("_key", "_own")
    lacking = F.sum(F.when(F.col("_key").isNull(), F.col("n")))
    found = texts.agg(F.max("_key").alias("top"), lacking.alias("lacking"), F.count_if(several).alias("taken")).first()
    if not (found["lacking"] or found["taken"]):
        return docs.withColumn("_row", key), None
    docs = docs.withColumn("_key", key)
    if found["taken"]:
        docs = docs.join(taken, "_key", "left")
    else:
        docs = docs.withColumn("_own", F.lit(None).cast("long"))
    strange = F.col("_key").isNull() | F.coalesce(F.col("_own") != digest, F.lit(False))
    order = [digest, F.col(f"`{text}`"), F.col("_place")]
    first = 0 if found["top"] is None else found["top"] + 1
    if first + (found["lacking"] or 0) + found["taken"] > 1 << 63:
        raise ValueError("no numbers are left above the largest id for rows without one")
    lacking = docs.filter(strange).withColumn("_place", F.monotonically_increasing_id())
    lacking = number_rows(lacking, order, first, "_row").drop("_place")
    return docs.filter(~strange).withColumn("_row", F.col("_key")).unionByName(lacking).drop("_key", "_own"), first


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    bands: int | None = None,
    rows: int = 4,
    block_rows: int = BLOCK_ROWS,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` for every document; ``kept``: it stands for its component.

    The ``component_id`` of a component without any id is above the largest id. ``bands`` of
    ``rows`` bins each; by default so many that a pair at ``percent`` shares none 4 times in a million.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    numbers, first = numbered(docs.select(f"`{id_column}`", f"`{text}`"), id_column, text)
    found = near_rows(numbers, words, percent, bands, rows, block_rows, text)
    if first is None:
        own = F.col("_row")
    else:
        named = numbers.select("_row", F.col(f"`{id_column}`").alias("_id")).filter(F.col("_row") >= first)
        found, own = found.join(named, "_row", "left"), F.when(F.col("_row") < first, F.col("_row")).otherwise(F.col("_id"))
    return found.select(own.alias(id_column), "n_shingles", "component_id", (F.col("_row") == F.col("component_id")).alias("kept"))


def near_rows(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    bands: int | None = None,
    rows: int = 4,
    block_rows: int = BLOCK_ROWS,
    text: str = "text",
) -> DataFrame:
    """``(_row, n_shingles, component_id)`` for the ``_row`` of every document."""
    texts = docs.select(F.col("_row").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    known = signatures(texts, words, bands or bands_for(percent, rows), rows).checkpoint()
    classes = known.filter("class is not null").groupBy("class").agg(
        F.min("id").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("bins").alias("bins")
    )
    members = shared_buckets(classes.select("rep", F.explode("keys").alias("key"))).checkpoint()
    nodes = classes.select("rep", "n", "bins", F.lit(1).alias("weight"))
    nodes = nodes.join(members.select("rep").distinct(), "rep", "left_semi").checkpoint()
    families = family_labels(members, nodes, lambda rows: likely_pairs(rows, percent), 8 * block_rows, block_rows)
    families = families.select(F.col("component").alias("group"), F.col("node").alias("rep")).checkpoint()
    ids = families.select(F.col("rep").alias("id"))
    sets = sets_of(only_ids(texts, ids), words).dropDuplicates(["id"])
    sets = sets.select(F.col("id").alias("rep"), "shingles", F.size("shingles").alias("weight")).checkpoint()
    labels = family_labels(families, sets, lambda rows: linked_pairs(rows, percent), BLOCK_SHINGLES, block_rows)
    named = classes.select("class", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("class", F.coalesce("component", "rep").alias("component_id"))
    out = known.select("id", "n", "class").join(named, "class", "left")
    return out.select(F.col("id").alias("_row"), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each component, that of the smallest id, with the columns of ``docs``.

    Of equal rows one stays, and of rows of one id and text that of the least hash of all columns.
    Of a component without any id one row stays, its id null.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.select(whole.alias("_all"), F.col(f"`{id_column}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    rows, _ = numbered(packed, "_id", "_text")
    found = near_rows(rows, text="_text", **options).filter("_row = component_id")
    rows = rows.join(found.groupBy("_row").agg(F.count(F.lit(1)).alias("_n")), "_row")
    least = F.min_by("_all", F.xxhash64(F.to_json("_all"))).alias("_all")
    again = rows.filter("_n > 1").groupBy("_row").agg(least).select("_all.*")
    return rows.filter("_n = 1").select("_all.*").unionByName(again)
