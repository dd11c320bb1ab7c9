"""Nearest vectors by an exact metric index.

Unit vectors lie in cells around fitted centres. By the triangle inequality a vector of a cell
is no nearer to a query than the query's distance to the centre less the cell's radius, or than the
cell's inner radius less that distance. A first round compares each query with the cells nearest
to it, as many as hold enough vectors, which bounds its ``k``-th distance; a second one visits only those
of the other cells that can still hold a nearer vector, or an equal one. The centres never decide a
result, only how much is compared: with vectors that form no groups all cells are visited.

Centres are fitted on a sample of ``SAMPLE`` rows at most; every vector is indexed. The driver holds
that sample, the centres (``CENTRE_BYTES`` at most) and three numbers of each cell. Large cells and
cells that many queries visit are split into blocks, so no task holds more than one block of both sides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from colophon.storage import fixed

SAMPLE, CENTRE_BYTES, ROUNDS = 8192, 32 << 20, 4
#: Base vectors and queries that meet in one task.
BASE_BLOCK, QUERY_BLOCK = 1 << 15, 1 << 12
#: Scores are told apart to so many places, so that equal vectors tie wherever they are compared.
PLACES = 12
#: Rounding of distances, squared: cosines are near to 1e-15, distances to its root.
SLACK = 1e-6


def unit(vectors: list) -> np.ndarray:
    rows = np.array(vectors, float)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ y.T)))


def usable(df: DataFrame) -> DataFrame:
    """Rows with a vector of numbers that isn't zero."""
    real = "vector is not null and size(vector) > 0 and exists(vector, v -> v <> 0) and forall(vector, v -> v is not null and not isnan(v) and abs(v) < double('inf'))"
    return df.select("id", "vector").filter(real)


def fit(base: DataFrame, count: int) -> dict[int, np.ndarray]:
    """Centres of each length of vectors, by a few rounds of nearest means over the sample."""
    part = min(1.0, SAMPLE / max(count, 1))
    rows = base.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(part * (1 << 20)) + 1).select("vector").limit(SAMPLE).collect()
    by_length: dict[int, list] = {}
    for r in rows:
        by_length.setdefault(len(r["vector"]), []).append(r["vector"])
    centres = {}
    for length, vectors in by_length.items():
        points = unit(vectors)
        most = CENTRE_BYTES // (8 * length * len(by_length))
        n = max(1, min(int(2 * count**0.5), len(points) // 4, most))
        held = points[np.random.RandomState(7).permutation(len(points))[:n]]
        for _ in range(ROUNDS):
            near = np.argmax(points @ held.T, axis=1)
            sums = np.zeros_like(held)
            np.add.at(sums, near, points)
            sizes = np.linalg.norm(sums, axis=1, keepdims=True)
            held = np.where(sizes > 1e-12, sums / np.maximum(sizes, 1e-12), held)
        centres[length] = held
    return centres


def placed(base: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """``base`` with the length of each vector, its cell and its distance to the centre.

    Vectors of a length that the sample lacks are in a cell of their own without a centre.
    """
    shared = base.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            vectors = batch.column("vector").to_pylist()
            lengths = np.array([len(v) for v in vectors], np.int32)
            cells, far = np.zeros(len(vectors), np.int32), np.zeros(len(vectors))
            for length in set(lengths.tolist()):
                at = np.flatnonzero(lengths == length)
                if length in shared.value:
                    d = distances(unit([vectors[k] for k in at]), shared.value[length])
                    cells[at] = d.argmin(axis=1)
                    far[at] = d.min(axis=1)
                else:
                    far[at] = np.inf
            columns = [batch.column("id"), batch.column("vector"), pa.array(lengths), pa.array(cells), pa.array(far)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "vector", "length", "cell", "far"])

    kinds = f"id {base.schema['id'].dataType.simpleString()}, vector {base.schema['vector'].dataType.simpleString()}, length int, cell int, far double"
    return base.mapInArrow(run, kinds)


class Cells:
    """Centres with how many vectors each cell holds, and how near and how far from the centre these are."""

    def __init__(self, base: DataFrame, centres: dict[int, np.ndarray]):
        stats = base.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n"), F.min("far").alias("low"), F.max("far").alias("high"))
        self.centres, self.held = centres, {}
        for r in stats.collect():
            if r["length"] not in self.held:
                size = len(centres.get(r["length"], [0]))
                self.held[r["length"]] = (np.zeros(size, np.int64), np.zeros(size), np.zeros(size))
            for k, name in enumerate(("n", "low", "high")):
                self.held[r["length"]][k][r["cell"]] = r[name]

    def sizes(self) -> list[tuple[int, int, int]]:
        return [(length, k, int(n)) for length, (counts, _, _) in self.held.items() for k, n in enumerate(counts) if n]

    def least(self, length: int, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query and cell the distance to the centre, and the least distance to a vector."""
        counts, low, high = self.held[length]
        if length not in self.centres:
            none = np.zeros((len(queries), 1))
            return none, none
        to = distances(queries, self.centres[length])
        near = np.maximum(0.0, np.maximum(to - high, low - to))
        return to, np.where(counts > 0, near, np.inf)


def visits(queries: DataFrame, cells: Cells, enough: int, threshold: float | None, second: bool) -> DataFrame:
    """``(id, vector, length, cell)``: the cells that queries visit in the first or the second round.

    The first takes the nearest cells until they hold ``enough`` vectors; for the second ``queries`` have the score ``bound``
    of the ``k``-th vector so far, null if there are fewer.
    """
    shared = queries.sparkSession.sparkContext.broadcast(cells)
    least_score = -1.0 if threshold is None else threshold

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            vectors, known = batch.column("vector").to_pylist(), shared.value
            bounds = batch.column("bound").to_pylist() if second else [None] * len(vectors)
            rows, lengths, found = [], [], []
            for length in {len(v) for v in vectors} & set(known.held):
                at = [k for k, v in enumerate(vectors) if len(v) == length]
                for start in range(0, len(at), 512):
                    part = at[start : start + 512]
                    to, near = known.least(length, unit([vectors[k] for k in part]))
                    counts = known.held[length][0]
                    for k, d, lows in zip(part, to, near):
                        order = np.argsort(np.where(counts > 0, d, np.inf), kind="stable")
                        first = order[: int(np.searchsorted(np.cumsum(counts[order]), enough)) + 1]
                        if second:
                            score = max(least_score, -1.0 if bounds[k] is None else bounds[k])
                            more = lows <= np.sqrt(max(0.0, 2.0 - 2.0 * score)) + SLACK
                            more[first] = False
                            first = np.flatnonzero(more)
                        else:
                            first = first[lows[first] <= np.sqrt(max(0.0, 2.0 - 2.0 * least_score)) + SLACK]
                        first = first[counts[first] > 0]
                        rows += [k] * len(first)
                        lengths += [length] * len(first)
                        found += first.tolist()
            took = pa.array(rows, pa.int32())
            columns = [batch.column("id").take(took), batch.column("vector").take(took), pa.array(lengths, pa.int32()), pa.array(found, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "vector", "length", "cell"])

    kinds = f"id {queries.schema['id'].dataType.simpleString()}, vector {queries.schema['vector'].dataType.simpleString()}, length int, cell int"
    return queries.mapInArrow(run, kinds)


def compared(asked: DataFrame, base: DataFrame, sizes: list[tuple[int, int, int]], k: int, same: bool) -> DataFrame:
    """``(query_id, base_id, score)``: of each cell visited the ``k`` best, block by block."""
    import pyarrow as pa

    spark = base.sparkSession
    types = [to_arrow_type(df.schema["id"].dataType) for df in (asked, base)]
    names = {r[:2]: r[2] for r in sizes}
    busy = {(r["length"], r["cell"]): r["n"] for r in asked.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = [(length, cell, -(-names[length, cell] // BASE_BLOCK), -(-n // QUERY_BLOCK)) for (length, cell), n in busy.items()]
    # one row for each cell, as many as there are centres
    plan = F.broadcast(spark.createDataFrame(plan, "length int, cell int, parts int, shares int"))
    where, both = ["length", "cell"], ["length", "cell", "part", "share"]

    def dealt(df: DataFrame, own: str, count: str, other: str, others: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), F.col(count)).cast("int").alias(own)
        return df.join(plan, where).select("id", "vector", *where, mine, F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias(other))

    def meet(left, right):
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            ids, own = left.column("id").to_pylist(), right.column("id").to_pylist()
            order = sorted(range(len(own)), key=lambda j: own[j])  # so that ties go by id
            vectors = right.column("vector").to_pylist()
            y = unit([vectors[j] for j in order])
            own = [own[j] for j in order]
            x = unit(left.column("vector").to_pylist())
            for start in range(0, len(x), 64):
                scores = np.round(x[start : start + 64] @ y.T, PLACES)
                for a, row in enumerate(scores, start):
                    want = min(k + 1, len(row))
                    edge = np.partition(row, len(row) - want)[len(row) - want]
                    at = np.flatnonzero(row >= edge)
                    best = at[np.argsort(-row[at], kind="stable")]
                    best = [j for j in best.tolist() if same or own[j] != ids[a]][:k]
                    out += [(ids[a], own[j], float(row[j])) for j in best]
        made = list(zip(*out)) if out else [(), (), ()]
        return pa.table({n: pa.array(list(c), t) for n, c, t in zip(("query_id", "base_id", "score"), made, (*types, pa.float64()))})

    kinds = [df.schema["id"].dataType.simpleString() for df in (asked, base)]
    left = dealt(asked, "share", "shares", "part", "parts").groupBy(*both)
    right = dealt(base, "part", "parts", "share", "shares").groupBy(*both)
    return left.cogroup(right).applyInArrow(meet, f"query_id {kinds[0]}, base_id {kinds[1]}, score double")


def best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "base_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(queries: DataFrame, base: DataFrame, k: int = 1, threshold: float | None = None, same: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(query_id, base_id, score)`` of the ``k`` base vectors of highest cosine, at or over ``threshold``,
    and ``(length, cell, queries, vectors)``: how many queries met the vectors of each cell.

    Both sides have id (of any type, unique) and vector. ``same`` false leaves out a vector itself. Ties go by base id.
    Vectors that are null, zero or hold null or non-finite numbers are in no result, nor are
    those of a length that the other side lacks. A table without such vectors has no results.
    """
    queries, base = usable(queries), usable(base)
    centres = fit(base, base.count())
    indexed = fixed(placed(base, centres))
    cells = Cells(indexed, centres)
    sizes = cells.sizes()
    enough = k + (not same)
    first = fixed(visits(queries, cells, enough, threshold, False))
    round_one = fixed(compared(first, indexed, sizes, k, same))
    kth = best_of(round_one, k).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("bound"))
    second = fixed(visits(queries.join(kth, "id", "left"), cells, enough, threshold, True))
    found = best_of(round_one.unionByName(compared(second, indexed, sizes, k, same)), k).drop("rank")
    if threshold is not None:
        found = found.filter(F.col("score") >= threshold)
    met = first.unionByName(second).groupBy("length", "cell").agg(F.count(F.lit(1)).alias("queries"))
    held = base.sparkSession.createDataFrame(sizes, "length int, cell int, vectors long")
    return found, met.join(F.broadcast(held), ["length", "cell"])
