"""Samples that can be drawn again, and the relevance of what they hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colophon.storage import fixed

# Substrings that decide relevance.
INCLUDE = ["battery", "batteries", "li-ion", "lithium-ion", "lithium-sulfur", "li-s", "state of charge", "state of health", "soc", "soh", "bms", "bess", "remaining useful life", "rul", "equivalent-circuit model", "cell balancing", "state of energy", "soe", "battery modeling", "battery model", "charge estimation", "health estimation"]
NOISE = ["solar cell", "solar cells", "photovoltaic cell", "photovoltaic cells", "fuel cell", "fuel cells", "microbial fuel", "biological cell", "biological cells", "cell division", "cancer cell", "cancer cells", "cellular network", "cellular networks", "5g", "lte", "cellular neural network", "cellular manufacturing", "cell biology"]
STRONG = ["battery management", "bms", "bess"]
STORAGE = "energy storage"
STORAGE_CONTEXT = ["grid", "microgrid", "renewable"]
RATIONALES = [
    "Matches battery keywords and contains no obvious noise keywords.",
    "Contains explicit noise keywords (e.g. solar/fuel cells, biological cells, or telecommunications) and lacks battery terms.",
    "Contains noise keywords but includes strong battery system terms like BMS/BESS.",
    "Contains both battery and noise keywords, likely focusing on fuel cell/solar cell hybrid systems or general power system applications.",
    "Mentions energy storage in grid/microgrid context.",
    "Does not contain strong battery or energy storage indicators.",
]


#: Beyond so many strata samples are drawn by strata.
MOST_STRATA = 40


def exact(df: DataFrame, k: int, key: str, seed: int = 42) -> DataFrame:
    """``k`` rows (all, if fewer) in order of a hash of the key and the seed."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(k)


def reservoir(df: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """``k`` rows with equal chances, in random order."""
    return df.orderBy(F.rand(seed)).limit(k)


def quotas(df: DataFrame, stratum: str, k: int) -> DataFrame:
    """``(stratum, count, quota)``: proportional, half to even; the largest stratum takes the rest."""
    counts = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("count"))
    every = Window.partitionBy()
    share = F.bround(F.lit(k) * F.col("count") / F.sum("count").over(every)).cast("long")
    out = counts.withColumn("quota", share)
    rest = F.lit(k) - F.sum("quota").over(every)
    first = F.row_number().over(every.orderBy(F.desc("count"), stratum)) == 1
    return out.select(stratum, "count", (F.col("quota") + F.when(first, rest).otherwise(0)).alias("quota"))


def stratified(df: DataFrame, stratum: str, k: int, key: str, seed: int = 42) -> DataFrame:
    """The quota of each stratum in order of a hash; a null stratum is one too.

    The hash is a number as good as random, so those under a bound hold the quota but for a chance
    in a million; what is under it, a few times the quota, is ranked. A stratum for which it isn't
    enough is ranked whole.
    """
    mark = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    wanted = quotas(df, stratum, k).select(F.col(stratum).alias("_stratum"), "quota", F.col("count").alias("_count"))
    bound = F.least(F.lit(1.0), (F.col("quota") + 6 * F.sqrt("quota") + 24) / F.col("_count"))
    wanted = fixed(wanted.filter("quota > 0").withColumn("_bound", bound))
    marked = df.withColumn("_mark", mark).join(wanted, F.col(stratum).eqNullSafe(F.col("_stratum")))
    place = F.conv(F.substring("_mark", 1, 12), 16, 10).cast("long") / (1 << 48)
    near = fixed(marked.filter(place <= F.col("_bound")))
    have = near.groupBy("_stratum").agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed("_stratum", "_s")
    short = wanted.join(have, F.col("_stratum").eqNullSafe(F.col("_s")), "left").filter("coalesce(_n, 0) < least(quota, _count)")
    again = [r["_stratum"] for r in short.select("_stratum").collect()]
    for value in again:  # as good as never
        one = F.col("_stratum").eqNullSafe(F.lit(value))
        near = near.filter(~one).unionByName(marked.filter(one))
    rank = F.row_number().over(Window.partitionBy("_stratum").orderBy("_mark", key))
    return near.withColumn("_rank", rank).filter(F.col("_rank") <= F.col("quota")).select(*df.columns)


def sample(df: DataFrame, k: int, key: str, stratum: str, mode: str = "auto", seed: int = 42, strata: int = 0) -> DataFrame:
    """By ``mode``: exact, reservoir, stratified or auto; beyond 40 ``strata`` auto and reservoir are stratified, else auto is exact."""
    if mode in ("auto", "reservoir") and strata > MOST_STRATA:
        mode = "stratified"
    if mode == "stratified":
        return stratified(df, stratum, k, key, seed)
    return reservoir(df, k, seed) if mode == "reservoir" else exact(df, k, key, seed)


def relevance(text: Column, include: list[str] = INCLUDE, noise: list[str] = NOISE) -> Column:
    """``(relevance, rationale)`` by substrings of the lower-case text."""
    low = F.lower(F.coalesce(text, F.lit("")))

    def has(words: list[str]) -> Column:
        out = low.contains(words[0])
        for w in words[1:]:
            out = out | low.contains(w)
        return out

    def outcome(name: str, k: int) -> Column:
        return F.struct(F.lit(name).alias("relevance"), F.lit(RATIONALES[k]).alias("rationale"))

    wanted, noisy = has(include), has(noise)
    return (
        F.when(wanted & ~noisy, outcome("Relevant", 0))
        .when(noisy & ~wanted, outcome("Noise", 1))
        .when(noisy & wanted & has(STRONG), outcome("Relevant", 2))
        .when(noisy & wanted, outcome("Noise", 3))
        .when(low.contains(STORAGE) & has(STORAGE_CONTEXT), outcome("Relevant", 4))
        .otherwise(outcome("Noise", 5))
    )
