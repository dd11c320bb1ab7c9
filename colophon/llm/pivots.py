"""Near-duplicate vectors by a pivot-permutation index.

Every vector is described by its nearest pivots, in order. Inverted lists hold, for each pivot, the
vectors that have it among their nearest. Members of a list are compared by the number of pivots
that they share; a pair that shares enough is a candidate, in the list of its smallest shared pivot
only, and candidates are verified by cosine in double precision.

Pivots come from a bounded sample of the vectors, no two of them within the threshold of each
other, and their number grows with the square root of the number of vectors. Places are relative to
the sample's mean, so a direction that all vectors have in common doesn't blur the order. How many
nearest pivots describe a vector is measured: partners at exactly the threshold are made for
vectors of the sample, in random directions and in directions from one vector to another, and the
least number is taken at which a share of ``recall`` of both sorts would meet as candidates.

Equal vectors are one class, so copies meet once. A long list is split into blocks by a hash of
the members, and pairs of blocks are compared apart, so no task holds more than two blocks at once.
What leaves a task is a row for each member: its links and the least member it is connected to.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component link with
nothing; vectors of different lengths don't link, and each length has an index of its own; repeated
ids are copies of each other; a row without an id links like others, and has the number after the largest id where none of its component has one; the smallest id stands for a component; an
empty table gives an empty result; only the columns named return, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from math import ceil, sqrt

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from colophon.llm.common import ensure_checkpoint_dir
from colophon.llm.graph import components, least_reached
from colophon.operators.ingest import number_rows

#: Pivots for each vector's square root, and the bytes of doubles that the pivots may have at most.
PIVOTS_PER_ROOT, PIVOT_BYTES = 8, 64 << 20
#: Vectors of the sample for each pivot, and vectors whose made partners measure the recall.
SAMPLE_PER_PIVOT, PROBES = 2, 1024
MOST_NEAREST = 32


def usable(column: str) -> Column:
    x = F.col(column)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return x.isNotNull() & finite & F.exists(x, lambda v: v != 0)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@dataclass(frozen=True)
class Index:
    """Pivots relative to ``mean``, numbered from ``first``; ``nearest`` of them describe a vector."""

    mean: np.ndarray
    pivots: np.ndarray
    nearest: int
    first: int = 0

    def describe(self, x: np.ndarray, nearest: int | None = None) -> np.ndarray:
        """Numbers of the nearest pivots of unit vectors, in order; ties go to the smaller number."""
        k = min(nearest or self.nearest, len(self.pivots))
        out = np.zeros((len(x), k), np.int32)
        far = (self.pivots**2).sum(axis=1)
        for a in range(0, len(x), 1024):
            distance = far - 2 * (x[a : a + 1024] - self.mean) @ self.pivots.T
            some = np.sort(np.argpartition(distance, k - 1, axis=1)[:, :k], axis=1)
            order = np.argsort(np.take_along_axis(distance, some, axis=1), axis=1, kind="stable")
            out[a : a + 1024] = np.take_along_axis(some, order, axis=1)
        return out + self.first


def partners(x: np.ndarray, threshold: float, seed: int = 0) -> list[np.ndarray]:
    """For each unit vector one with a cosine of ``threshold`` to it, in a random direction, and one towards another vector."""
    random = np.random.default_rng(seed)
    made = []
    for to in (random.normal(size=x.shape), x[random.permutation(len(x))] - x[random.permutation(len(x))]):
        to = to - (to * x).sum(axis=1, keepdims=True) * x
        size = np.linalg.norm(to, axis=1, keepdims=True)
        made.append(threshold * x + sqrt(max(0.0, 1 - threshold * threshold)) * np.divide(to, size, out=np.zeros_like(to), where=size > 1e-9))
    return made


def fit(sample: np.ndarray, count: int, threshold: float, shared: int, recall: float, first: int = 0) -> Index:
    """The index of ``count`` vectors from a ``sample`` of them in a repeatable random order."""
    x = unit(np.unique(sample, axis=0))
    x = x[np.random.default_rng(len(x)).permutation(len(x))]
    mean = x.mean(axis=0)
    wanted = min(max(64, ceil(PIVOTS_PER_ROOT * sqrt(count))), PIVOT_BYTES // (8 * x.shape[1]))
    chosen: list[int] = []
    free = np.ones(len(x), bool)
    for k in range(len(x)):
        if free[k] and len(chosen) < wanted:
            chosen.append(k)
            free[k:] &= x[k:] @ x[k] < threshold
    index = Index(mean, x[chosen] - mean, min(shared, len(chosen)), first)
    probes = x[:PROBES]
    most = min(MOST_NEAREST, len(chosen))
    here = index.describe(probes, most)
    same = [here[:, :, None] == index.describe(unit(y), most)[:, None, :] for y in partners(probes, threshold)]
    nearest = next(
        (k for k in range(index.nearest, most) if all((s[:, :k, :k].sum(axis=(1, 2)) >= min(shared, k)).mean() >= recall for s in same)),
        most,
    )
    return Index(mean, index.pivots, nearest, first)


def indexes(rows: DataFrame, threshold: float, shared: int, recall: float) -> dict[int, Index]:
    """An index for each length of the usable vectors in ``rows`` (``id, vector``)."""
    length = F.size("vector")
    counts = {r["length"]: r["count"] for r in rows.groupBy(length.alias("length")).count().collect()}
    out: dict[int, Index] = {}
    first = 0
    for size, count in sorted(counts.items()):
        most = SAMPLE_PER_PIVOT * min(max(64, ceil(PIVOTS_PER_ROOT * sqrt(count))), max(1, PIVOT_BYTES // (8 * size)))
        part = F.pmod(F.xxhash64("id", "vector"), F.lit(1 << 30))
        found = rows.filter((length == size) & (part < min(1.0, 1.2 * most / count) * (1 << 30)))
        found = found.orderBy(part, "id").limit(most).select("vector").collect()
        sample = np.array([r["vector"] for r in found], float)
        if len(sample):
            out[size] = fit(sample, count, threshold, shared, recall, first)
            first += len(out[size].pivots)
    return out


def describe(vectors: DataFrame, found: dict[int, Index]) -> DataFrame:
    """``(id, class, nearest, vector)``: a digest that equal vectors share, and the nearest pivots in order."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = batch.column(1)
            lengths = np.array([-1 if n is None else n for n in rows.value_lengths().to_pylist()], np.int64)
            digests: list = [None] * len(rows)
            near: list = [None] * len(rows)
            for size in np.unique(lengths).tolist():
                if size in found:
                    at = np.flatnonzero(lengths == size)
                    x = rows.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, size) + 0.0
                    for k, v, order in zip(at.tolist(), x, found[size].describe(unit(x.astype(float)))):
                        digests[k], near[k] = blake2b(v.tobytes(), digest_size=16).digest(), order
            columns = [batch.column(0), pa.array(digests, pa.binary()), pa.array(near, pa.list_(pa.int32())), rows]
            yield pa.RecordBatch.from_arrays(columns, ["id", "class", "nearest", "vector"])

    kind = vectors.schema["vector"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id long, class binary, nearest array<int>, vector {kind}")


def compare(rows, pivot: int, crossed: bool, shared: int, threshold: float):
    """Links of the members of one block of a list, or of two, each pair once for each end."""
    import pyarrow as pa

    rows = rows.sort_by("rep").combine_chunks()
    ids, weights, side = (rows.column(c).to_numpy() for c in ("rep", "weight", "at"))
    m = len(ids)
    near, x = (rows.column(c).combine_chunks().flatten().to_numpy().reshape(m, -1) for c in ("nearest", "vector"))
    x = unit(x.astype(float))
    named, column = np.unique(near, return_inverse=True)
    has = np.zeros((m, len(named)), np.float32)
    has[np.arange(m)[:, None], column.reshape(near.shape)] = 1
    before = has[:, named < pivot]
    linked = np.zeros((m, m), bool)
    for a in range(0, m, 512):
        b = min(a + 512, m)
        counts = has[a:b] @ has.T
        candidates = (counts >= min(shared, near.shape[1])) & (before[a:b] @ before.T == 0) if before.shape[1] else counts >= min(shared, near.shape[1])
        candidates &= np.arange(a, b)[:, None] < np.arange(m)
        if crossed:
            candidates &= side[a:b, None] != side
        i, j = np.nonzero(candidates)
        for k in range(0, len(i), 1 << 16):
            p, q = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
            true = np.einsum("ij,ij->i", x[a + p], x[q]) >= threshold
            linked[a + p[true], q[true]] = True
    linked |= linked.T
    links = np.array([weights[row].sum() for row in linked], np.int64)
    least = least_reached(linked)
    some = links > 0
    return pa.table({"rep": ids[some], "links": links[some], "least": ids[least[some]]})


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.95,
    shared: int = 2,
    recall: float = 0.99,
    block_rows: int = 1024,
    id_column: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``(id, n_links, component_id)`` for every vector; links have a cosine of ``threshold`` or more.

    A pair is a candidate if it has ``shared`` pivots in common; ``recall`` is the share of pairs at
    the threshold that the index is fitted to find.
    """
    ensure_checkpoint_dir(vectors.sparkSession)
    kind = vectors.schema[vector].dataType
    plain = "array<float>" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "array<double>"
    rows = vectors.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector}`").cast(plain).alias("vector"))
    rows = rows.withColumn("vector", F.when(usable("vector"), F.col("vector")))
    ids = rows.agg(F.max("id").alias("top"), F.count_if(F.col("id").isNull()).alias("lacking")).first()
    first = 0 if ids["top"] is None else ids["top"] + 1
    if ids["lacking"]:  # rows without an id go by a number above all ids
        numbered = number_rows(rows.filter("id is null").drop("id"), [F.xxhash64("vector")], first, "id")
        rows = rows.filter("id is not null").unionByName(numbered)
    found = indexes(rows.filter("vector is not null"), threshold, shared, recall)
    described = describe(rows, found).checkpoint()
    classes = (
        described.filter("class is not null")
        .groupBy("class")
        .agg(
            F.min("id").alias("rep"),
            F.count(F.lit(1)).alias("weight"),
            F.first("nearest").alias("nearest"),
            F.first("vector").alias("vector"),
        )
        .checkpoint()
    )
    entries = classes.select("rep", F.explode("nearest").alias("pivot"))
    sizes = entries.groupBy("pivot").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    sizes = sizes.select("pivot", F.ceil(F.col("members") / block_rows).cast("int").alias("blocks"))
    met = entries.join(sizes, "pivot").withColumn("at", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    met = met.select("rep", "pivot", "at", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    met = met.select("rep", "pivot", "at", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"))
    members = met.join(classes.select("rep", "weight", "nearest", "vector"), "rep")

    def run(key, table):
        pivot, i, j = (k.as_py() for k in key)
        return compare(table, pivot, i != j, shared, threshold)

    pairs = members.groupBy("pivot", "i", "j").applyInArrow(run, "rep long, links long, least long").checkpoint()
    labels = components(pairs.select(F.col("rep").alias("a"), F.col("least").alias("b")))
    counts = pairs.groupBy("rep").agg(F.sum("links").alias("links"))
    named = classes.select("class", "rep", "weight").join(counts, "rep", "left")
    named = named.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "class",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    out = described.select("id", "class").join(named, "class", "left")
    own = F.when(F.col("id") < first, F.col("id")) if ids["lacking"] else F.col("id")
    return out.select(
        own.alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
