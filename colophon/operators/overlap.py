"""Sets of identifiers compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_set(df: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """Distinct keys without null."""
    return df.select(key.alias(name)).dropna().distinct()


def report(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """One row: sizes of both sets of ``key``, of what they share, and of what one has alone."""
    a, b = ours.withColumn("a", F.lit(1)), theirs.withColumn("b", F.lit(1))
    joined = a.join(b, "key", "full")
    counts = joined.agg(
        F.count("a").alias("ours"),
        F.count("b").alias("theirs"),
        F.count(F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), 1)).alias("shared"),
    )
    share = F.bround(F.try_divide(100.0 * F.col("shared"), F.col("theirs")), 2)
    return counts.withColumns(
        {"only_ours": F.col("ours") - F.col("shared"), "only_theirs": F.col("theirs") - F.col("shared"), "shared_percent": share}
    )


def only_in(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Keys of ``ours`` that ``theirs`` lacks, in order."""
    return ours.subtract(theirs).orderBy("key")


def rows_only_theirs(rows: DataFrame, key: Column, ours: DataFrame) -> DataFrame:
    """Whole rows, repeated ones too, whose key is not null and not among ours."""
    marked = rows.withColumn("_key", key).filter("_key is not null")
    return marked.join(ours.select(F.col("key").alias("_key")), "_key", "left_anti").drop("_key")


def absent_rows(rows: DataFrame, key: Column, known: DataFrame) -> DataFrame:
    """Rows whose key is null or not among ``known``."""
    marked = rows.withColumn("_key", key)
    return marked.join(known.select(F.col("key").alias("_key")), "_key", "left_anti").drop("_key")
