"""Mixing sources to target weights: copies of documents whose words meet targets.

Entropy balancing: of all rates that meet the targets, those nearest to one copy of each document, by
relative entropy over words, are ``exp`` of a sum of multipliers, one for each value of each margin (a
source, say, or a source and a language), and at most ``CAP``. The multipliers minimise a convex
dual. Its gradient for a value is the words at the present rates less the target, its curvature those
words again, so a Newton step needs only sums by value. Rates depend on a document through
its stratum (its values of all margins) alone: the steps sum over strata, never over
documents, and run as Spark aggregations. Margins are stepped through in turn.

Rates become copies stratum by stratum. Documents of a stratum with equally many words are alike;
from the longest to the shortest their copies are rounded so that the words still owed are carried
on to the next length. What is left over is about half of the shortest document. Which of the documents of
a length take one copy more is decided by a hash of their ids, the same at every run.

Hot strata: all sums have map-side parts. Lengths with very many documents (``HOT_ROWS``, and a
thousandth of all, so a thousand of them at most) are split into parts by hash before they are ranked.

Defined results: a null margin is a value of its own, after all others; documents without words
take no copies; a null text has no words; a null id is hashed as an empty text; repeated rows are
documents of their own; an empty table has no rows. Where whole copies of few and long documents
can't give a target's words, they come as near as rounding from the longest down does.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colophon.llm.common import WORD, ensure_checkpoint_dir

#: No document is taken more often than this.
CAP = 3
#: Newton sweeps at most, and the largest gap to a target, as a part of it, that ends them.
SWEEPS, GAP = 60, 1e-12
#: A length's documents are ranked in parts if there are more than so many.
HOT_ROWS = 4096
#: Lengths whose rounding is chained in one row.
CHAIN = 1024


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def margin_key(value: Column) -> Column:
    """A text for each value; null has one of its own, after all others."""
    return F.coalesce(F.concat(F.lit("v"), value.cast("string")), F.lit("w"))


def shared_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: float = CAP) -> DataFrame:
    """``sizes`` (key, size) with ``weight`` and ``target``.

    Keys in order take the weights by turns and share all sizes in proportion to them, but none over
    ``cap`` times its own: what is over is shared again by weight among the others. Values are filled
    in order of how soon they are full; a value is full if the level of all that come before it and of itself
    would be over its own. One row for each key meets in one task, no documents.
    """
    place = F.row_number().over(Window.orderBy("key")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight.cast("double")).withColumn("most", F.col("size") * F.lit(float(cap)))
    soon = Window.orderBy(F.col("most") / F.col("weight"), "key")
    before = soon.rowsBetween(Window.unboundedPreceding, -1)
    every = soon.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.sum("size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    heavy = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumns({"rest": rest, "heavy": heavy, "place": F.row_number().over(soon)})
    open_ = rows.withColumn("open", F.col("rest") * F.col("weight") <= F.col("most") * F.col("heavy"))
    level = F.min_by(F.col("rest") / F.col("heavy"), F.when(F.col("open"), F.col("place"))).over(every)
    first = F.min(F.when(F.col("open"), F.col("place"))).over(every)
    found = open_.withColumns({"level": level, "first": first})
    target = F.when(F.col("place") >= F.col("first"), F.col("weight") * F.col("level")).otherwise(F.col("most"))
    return found.select("key", "size", "weight", target.alias("target"))


def rates(strata: DataFrame, margins: Sequence[str], targets: Mapping[str, DataFrame], cap: float = CAP) -> DataFrame:
    """``strata`` (a key for each margin, ``size``) with ``rate``.

    Newton's method on the dual, a margin at a time, as the curvature between values of one margin
    is zero. The rate counts as ``exp`` below the cap and stays at it beyond; a value all of whose strata
    are at the cap has no step left up. Each sweep is kept in the shared folder.
    """
    ensure_checkpoint_dir(strata.sparkSession)
    power = F.col("power")
    rate = F.least(F.lit(float(cap)), F.exp(power))
    now = strata.withColumn("power", F.lit(0.0)).checkpoint()
    wanted = {m: targets[m].select(F.col("key").alias(m), F.col("target").cast("double")).checkpoint() for m in margins}
    before = float("inf")
    for sweep in range(SWEEPS):
        gaps = []
        for m in margins:
            free = F.when(power < F.log(F.lit(float(cap))), F.col("size") * rate).otherwise(0.0)
            sums = now.groupBy(m).agg(F.sum(F.col("size") * rate).alias("have"), F.sum(free).alias("curve"))
            gap = F.col("target") - F.col("have")
            # a step of more than one power of e at once would leave where the quadratic holds
            up = F.when(F.col("curve") > 0, F.least(gap / F.col("curve"), F.lit(1.0))).otherwise(0.0)
            down = F.greatest(gap / F.greatest(F.col("curve"), F.col("have")), F.lit(-1.0))
            step = F.when(F.col("have") <= 0, 0.0).when(gap > 0, up).otherwise(down)
            off = F.when(F.col("have") > 0, F.abs(gap) / F.greatest(F.col("target"), F.lit(1.0))).otherwise(0.0)
            steps = sums.join(wanted[m], m).select(m, step.alias("step"), off.alias("off"))
            now = now.join(steps.hint("merge"), m).withColumn("power", power + F.col("step")).drop("step")
            now = now.withColumnRenamed("off", f"off_{m}")
            gaps.append(f"off_{m}")
        now = now.checkpoint()
        worst = now.agg(F.max(F.greatest(*gaps, F.lit(0.0)))).first()[0] or 0.0
        now = now.drop(*gaps)
        if worst <= GAP or sweep >= 20 and worst >= 0.9 * before:  # no rates meet these targets
            break
        before = worst if sweep % 5 == 0 else before
    return now.withColumn("rate", rate).drop("power")


def copies_by_length(lengths: DataFrame, cap: int = CAP) -> DataFrame:
    """``lengths`` (stratum, size, n, rate) with ``copies``, all that the documents of a length take.

    Lengths go from the longest down, ``CHAIN`` of them in a row; each rounds what it owes and what was
    carried to it. A row's last carry is lost: at most half of its shortest document in over a thousand.
    """
    order = Window.partitionBy("stratum").orderBy(F.desc("size"))
    chains = lengths.withColumn("chain", F.floor((F.row_number().over(order) - 1) / CHAIN))
    item = F.struct((-F.col("size")).alias("down"), "size", "n", "rate")
    chains = chains.groupBy("stratum", "chain").agg(F.array_sort(F.collect_list(item)).alias("items"))

    def take(state: Column, x: Column) -> Column:
        owed = state["carry"] + x["n"] * x["rate"] * x["size"]
        whole = F.floor(owed / F.greatest(x["size"], F.lit(1)) + 0.5)
        k = F.when(x["size"] > 0, F.least(F.greatest(whole, F.lit(0)), x["n"] * cap)).otherwise(0).cast("long")
        return F.struct((owed - k * x["size"]).alias("carry"), F.concat(state["taken"], F.array(k)).alias("taken"))

    start = F.struct(F.lit(0.0).alias("carry"), F.array().cast("array<bigint>").alias("taken"))
    taken = chains.select("stratum", "items", F.aggregate("items", start, take)["taken"].alias("taken"))
    pairs = taken.select("stratum", F.explode(F.arrays_zip("items", "taken")).alias("x"))
    return pairs.select("stratum", F.col("x.items.size").alias("size"), F.col("x.items.n").alias("n"), F.col("x.taken").alias("copies"))


def mix(docs: DataFrame, margins: Sequence[str], targets: Mapping[str, DataFrame], cap: int = CAP) -> DataFrame:
    """``docs`` (id, size and a key for each margin) with ``copies``, 0 to ``cap``, for each row.

    Also ``size_m`` and ``target_m`` of each margin m. ``targets``: for each margin a table of key,
    size and target.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    hashed = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))
    stratum = F.to_json(F.array(*margins)) if len(margins) > 1 else F.col(margins[0])
    rows = docs.select("id", "size", *margins, stratum.alias("stratum"), hashed.alias("hash")).checkpoint()
    lengths = rows.groupBy("stratum", *margins, "size").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    strata = lengths.groupBy("stratum", *margins).agg(F.sum(F.col("n") * F.col("size")).alias("size"))
    found = rates(strata, margins, targets, cap)
    said = []
    for m in margins:
        names = (f"size_{m}", f"target_{m}")
        found = found.join(targets[m].select(F.col("key").alias(m), *[F.col(c).alias(n) for c, n in zip(("size", "target"), names)]).hint("merge"), m)
        said += names
    found = found.select("stratum", F.round("rate", 11).alias("rate"), *said)
    plan = copies_by_length(lengths.drop(*margins).join(found.select("stratum", "rate").hint("merge"), "stratum"), cap)
    plan = plan.join(found.drop("rate").hint("merge"), "stratum").checkpoint()

    total = lengths.agg(F.sum("n").alias("n")).first()["n"] or 0
    # the bound of this broadcast: a thousand lengths have a thousandth of the documents each
    hot = plan.filter(F.col("n") > max(HOT_ROWS, total // 1000))
    hot = hot.select("stratum", "size", F.ceil(F.col("n") / HOT_ROWS).alias("parts"))
    first = F.conv(F.substring("hash", 1, 8), 16, 10).cast("long")
    rows = rows.join(F.broadcast(hot), ["stratum", "size"], "left")
    rows = rows.withColumn("part", F.coalesce(F.floor(first * F.col("parts") / (1 << 32)), F.lit(0))).drop("parts")

    # each part of a length takes its share of the copies that are over, so that the shares add up
    key = ["stratum", "size", "part"]
    parts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("m")).join(plan.hint("merge"), ["stratum", "size"])
    upto = F.sum("m").over(Window.partitionBy("stratum", "size").orderBy("part"))
    over = F.col("copies") % F.col("n")

    def share(count: Column) -> Column:
        return F.floor(over * (count / F.col("n")))

    parts = parts.withColumn("upto", upto)
    more = share(F.col("upto")) - share(F.col("upto") - F.col("m"))
    parts = parts.select(*key, F.floor(F.col("copies") / F.col("n")).alias("each"), more.alias("more"), *said)
    joined = rows.join(parts.hint("merge"), key)
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("hash"))
    copies = F.col("each") + (rank <= F.col("more")).cast("int")
    return joined.withColumn("copies", copies).select("id", "size", *margins, *said, "copies")


def mix_sources(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = CAP) -> DataFrame:
    """Documents (id, text, source) with ``size`` in words, their source's size and target, and ``copies``."""
    rows = docs.select("id", words(F.col("text")).alias("size"), margin_key(F.col("source")).alias("source"))
    ensure_checkpoint_dir(docs.sparkSession)
    rows = rows.checkpoint()  # texts are read once
    sizes = rows.groupBy(F.col("source").alias("key")).agg(F.sum("size").alias("size"))
    targets = shared_targets(sizes, weights, cap).checkpoint()
    return mix(rows, ["source"], {"source": targets}, cap)
