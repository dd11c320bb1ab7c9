"""Merkle manifest: a digest for a dataset, and for each row the proof that it belongs to it.

Rows are leaves; per group they ascend by an order column, and each run of ``ARITY`` nodes becomes
their digest until one is left, the group's subroot. Subroots, ordered by group, make the root by the
same rule.

Rows are sorted into ranges. A range resolves what it can by itself and keeps, for each tree and
level, the few nodes at its ends whose runs are not complete: a sparse forest. Forests merge by
union, and a run whose size is known becomes its parent as soon as all its nodes are there, so the
merge is associative and commutative; ``treeReduce`` merges them to the root. Runs that only
a merge completed (seams) are kept beside it: they are all that a range lacks to write its rows' proofs.

What the driver and a broadcast hold: for each range a few numbers and, for each level, one seam of
``ARITY`` digests at most. Ranges number ``MOST_RANGES`` at most, so that is bounded by
``MOST_RANGES * 16 * ARITY * 32`` bytes, 32 MiB, whatever the input. A range holds its digests as
32 bytes a row. Leaves are computed in one scan; texts are in no shuffle.

Defined results: a null group or order value comes first; rows equal in both are ordered by leaf, and
repeated rows are leaves of their own; a null value in a leaf is ``-``, an empty one ``0:``; an empty
table has no rows and no root; other columns take no part.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.llm.common import ensure_checkpoint_dir

ARITY = 8
#: Ranges of rows: so many rows each, until there are so many ranges.
RANGE_ROWS, MOST_RANGES = 50_000, 8192
#: Neighbouring ranges that are merged before treeReduce takes over.
NEIGHBOURS = 32
#: The tree of subroots; a group's tree has the group's place from 0 on.
TOP = -1

Node = tuple[int, int, int]  # tree, level, index


def digest_of(*values: Column) -> Column:
    """Lower-case hex SHA-256 of the values: ``-`` for null, else UTF-8 bytes, a colon, the value."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, values)), 256)


def parent(children: list[bytes]) -> bytes:
    """Digest of nodes (32 bytes each), which go in as hex text."""
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def run_length(size: int, run: int) -> int:
    return min(ARITY, size - ARITY * run)


def above(size: int) -> int:
    return -(-size // ARITY)


class Forest:
    """Unresolved nodes by tree, level and index, the leaf counts of their trees, and the seams."""

    def __init__(self):
        self.nodes: dict[Node, bytes] = {}
        self.sizes: dict[int, int] = {}
        self.seams: dict[Node, list[bytes]] = {}

    def size(self, tree: int, level: int) -> int:
        n = self.sizes[tree]
        for _ in range(level):
            n = above(n)
        return n

    def settle(self, nodes: list[Node]) -> None:
        """Parents of the complete runs around ``nodes``, and their parents."""
        while nodes:
            tree, level, index = nodes.pop()
            if (tree, level, index) not in self.nodes:
                continue
            size = self.size(tree, level)
            if size == 1:
                if tree != TOP:
                    up = (TOP, 0, tree)
                    self.nodes[up] = self.nodes.pop((tree, level, index))
                    nodes.append(up)
                continue
            run = index // ARITY
            keys = [(tree, level, ARITY * run + k) for k in range(run_length(size, run))]
            if all(k in self.nodes for k in keys):
                children = [self.nodes.pop(k) for k in keys]
                self.seams[tree, level, run] = children
                self.nodes[tree, level + 1, run] = parent(children)
                nodes.append((tree, level + 1, run))

    def merge(self, other: Forest) -> Forest:
        self.sizes |= other.sizes
        self.seams |= other.seams
        self.nodes |= other.nodes
        self.settle(list(other.nodes))
        return self

    @property
    def root(self) -> bytes | None:
        return next(iter(self.nodes.values())) if len(self.nodes) == 1 else None


class Strip:
    """The nodes of one tree that a range of its leaves resolves, level by level."""

    def __init__(self, tree: int, start: int, leaves: list[bytes], size: int):
        self.tree, self.levels, self.left = tree, [(start, leaves, size)], {}
        while size > 1:  # beyond what the range resolves, levels without nodes
            end = start + len(leaves)
            first, last = (above(start), above(end) if end == size else end // ARITY) if leaves else (0, 0)
            keep = [*range(start, min(end, ARITY * first)), *range(max(start, ARITY * last), end)] if last > first else range(start, end)
            for index in keep:
                self.left[tree, len(self.levels) - 1, index] = leaves[index - start]
            leaves = [parent(leaves[max(0, ARITY * r - start) : ARITY * (r + 1) - start]) for r in range(first, last)]
            start, size = first if leaves else 0, above(size)
            self.levels.append((start, leaves, size))

    @property
    def root(self) -> bytes | None:
        """The tree's root if the range holds the whole tree."""
        _, nodes, size = self.levels[-1]
        return nodes[0] if size == 1 and nodes else None

    def run(self, level: int, run: int, seams: dict[Node, list[bytes]]) -> list[bytes]:
        """The nodes of a run, from the range itself or the seams."""
        if (found := seams.get((self.tree, level, run))) is not None:
            return found
        start, nodes, _ = self.levels[level]
        return nodes[ARITY * run - start : ARITY * (run + 1) - start]


def strips(groups: list[list[bytes]], place: tuple[int, int, int, int, int]) -> tuple[list[Strip], Strip]:
    """The trees of a range and the tree of their subroots.

    ``place``: the first group's tree, the place of the range's first row in it, the leaves of the
    first and of the last group in the whole table, and the number of groups.
    """
    tree, start, first, last, count = place
    found = []
    for k, leaves in enumerate(groups):
        size = first if k == 0 else last if k == len(groups) - 1 else len(leaves)
        found.append(Strip(tree + k, start if k == 0 else 0, leaves, size))
    whole = [s for s in found if s.root is not None]
    return found, Strip(TOP, whole[0].tree if whole else 0, [s.root for s in whole], count)


def forest(groups: list[list[bytes]], place: tuple[int, int, int, int, int]) -> Forest:
    """What a range can't resolve by itself."""
    out = Forest()
    trees, top = strips(groups, place)
    for s in trees:
        if s.root is None:
            out.nodes |= s.left
            out.sizes[s.tree] = s.levels[0][2]
    out.nodes |= top.left
    out.sizes[TOP] = place[4]
    if top.root is not None:
        out.nodes[TOP, len(top.levels) - 1, 0] = top.root
    return out


def beside(nodes: list[bytes], at: int) -> tuple[bytes, bytes]:
    """The hex text before and after a node in its run."""
    hexes = [n.hex() for n in nodes]
    return "".join(hexes[:at]).encode(), "".join(hexes[at + 1 :]).encode()


def folded(leaf: bytes, steps: list[tuple[bytes, bytes]]) -> str:
    """The root that a leaf and its siblings give."""
    text = leaf.hex()
    for before, after in steps:
        text = hashlib.sha256(before + text.encode() + after).hexdigest()
    return text


def proofs(groups: list[list[bytes]], place: tuple[int, int, int, int, int], seams: dict[Node, list[bytes]]) -> Iterator[tuple[bytes, list]]:
    """For each leaf of a range its group's subroot and its (before, after) level by level to the root."""
    trees, top = strips(groups, place)

    def climb(strip: Strip, level: int, index: int) -> list[tuple[bytes, bytes]]:
        steps = []
        while strip.levels[level][2] > 1:
            steps.append(beside(strip.run(level, index // ARITY, seams), index % ARITY))
            level, index = level + 1, index // ARITY
        return steps

    for strip in trees:
        start, leaves, size = strip.levels[0]
        over_top = climb(top, 0, strip.tree)
        subroot, run, rest, nodes = strip.root, None, [], []
        for k, leaf in enumerate(leaves):
            index = start + k
            if index // ARITY != run:
                run = index // ARITY
                rest = climb(strip, 1, run) if size > 1 else []
                nodes = strip.run(0, run, seams) if size > 1 else []
            own = [beside(nodes, index % ARITY), *rest] if size > 1 else []
            if subroot is None:
                subroot = bytes.fromhex(folded(leaf, own))
            yield subroot, own + over_top


def ranges(leaves: DataFrame) -> DataFrame:
    """``leaves`` in sorted ranges, numbered by ``part`` and kept in the shared folder."""
    ensure_checkpoint_dir(leaves.sparkSession)
    kept = leaves.checkpoint()  # else the bounds of the ranges would cost a scan of their own
    order = [F.col(c).asc_nulls_first() for c in ("group", "place", "leaf")]
    n = min(MOST_RANGES, -(-kept.count() // RANGE_ROWS) or 1)
    return kept.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).checkpoint()


def places(rows: DataFrame) -> dict[int, tuple[int, int, int, int, int]]:
    """For each range the places of its rows (see ``strips``), from a few numbers of each range."""
    group = F.struct(F.col("group").isNotNull().alias("known"), F.col("group").alias("value"))
    runs = rows.groupBy("part", group.alias("g")).agg(F.count(F.lit(1)).alias("n"))
    ends = runs.groupBy("part").agg(
        F.min("g").alias("first"), F.max("g").alias("last"), F.min_by("n", "g").alias("n_first"), F.max_by("n", "g").alias("n_last"), F.count(F.lit(1)).alias("groups")
    )
    found = sorted(ends.collect(), key=lambda r: r["part"])
    out, tree, held, before = [], -1, 0, None  # held: rows so far of the group that the last range ended with
    for r in found:
        same = before is not None and r["first"] == before
        tree, start = (tree, held) if same else (tree + 1, 0)
        out.append([r["part"], tree, start])
        tree += r["groups"] - 1
        held = (start if r["groups"] == 1 else 0) + r["n_last"]
        before = r["last"]
    count, after, total = tree + 1, None, 0
    for r, row in zip(reversed(found), reversed(out)):
        total = total if after is not None and r["last"] == after else row[2] * (r["groups"] == 1) + r["n_last"]
        last = total
        first = last if r["groups"] == 1 else row[2] + r["n_first"]
        row += [first, last]
        after, total = r["first"], first
    return {part: (tree, start, first, last, count) for part, tree, start, first, last in out}


def gathered(batches: Iterator) -> tuple[int | None, list, list[list[bytes]]]:
    """The number of a range, its batches, and its leaves by group."""
    part, held, groups, before = None, [], [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if part is None:
            part, before = batch.column("part")[0].as_py(), (batch.column("group")[0].as_py(),)
            groups.append([])
        for group, leaf in zip(batch.column("group").to_pylist(), batch.column("leaf").to_pylist()):
            if (group,) != before:
                groups.append([])
                before = (group,)
            groups[-1].append(leaf)
    return part, held, groups


def reduced(rows: DataFrame, where: dict[int, tuple]) -> Forest:
    """The whole table's forest: its root, and the seams."""

    def build(batches: Iterator) -> Iterator:
        import pyarrow as pa

        part, _, groups = gathered(batches)
        if part is not None:
            made = pickle.dumps(forest(groups, where[part]))
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "forest": [made]})

    built = rows.select("part", "group", "leaf").mapInArrow(build, "part int, forest binary").rdd
    near = built.map(lambda r: (r["part"] // NEIGHBOURS, pickle.loads(r["forest"])))
    near = near.reduceByKey(Forest.merge, -(-(max(where) + 1) // NEIGHBOURS)).values()
    return near.treeReduce(Forest.merge)


def manifest(leaves: DataFrame) -> DataFrame:
    """Each leaf with its proof.

    ``leaves``: group, place, leaf and seen (hex digests). ``seen`` is the leaf as found now,
    folded with the original siblings; null is taken as a missing leaf of no bytes, which never
    verifies. Returns place, group, leaf, subroot, root, proof_sha256 (of all siblings from left to
    right, level by level), folded_root and verified.
    """
    spark = leaves.sparkSession
    out = "place string, group string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    out = out.replace("place string", f"place {leaves.schema['place'].dataType.simpleString()}")
    binary = leaves.select("group", "place", F.unhex("leaf").alias("leaf"), F.unhex("seen").alias("seen"))
    rows = ranges(binary)
    where = places(rows)
    if not where:
        return spark.createDataFrame([], out)
    whole = reduced(rows, where)
    shared = spark.sparkContext.broadcast((whole.seams, where, whole.root))

    def prove(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seams, known, root = shared.value
        part, held, groups = gathered(batches)
        if part is None:
            return
        found, root = proofs(groups, known[part], seams), root.hex()
        for batch in held:
            said: list[tuple] = []
            for leaf, seen in zip(batch.column("leaf").to_pylist(), batch.column("seen").to_pylist()):
                subroot, steps = next(found)
                proof = hashlib.sha256(b"".join(x for pair in steps for x in pair)).hexdigest()
                now = folded(seen or b"", steps)
                said.append((leaf.hex(), subroot.hex(), root, proof, now, now == root))
            names = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
            columns = dict(zip(names, map(list, zip(*said))))
            yield pa.RecordBatch.from_pydict({"place": batch.column("place"), "group": batch.column("group"), **columns})

    return rows.mapInArrow(prove, out)


def manifest_root(leaves: DataFrame) -> str | None:
    """The root alone; null of an empty table."""
    rows = ranges(leaves.select("group", "place", F.unhex("leaf").alias("leaf")))
    where = places(rows)
    return reduced(rows, where).root.hex() if where else None
