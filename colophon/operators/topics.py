"""Distribution of topics and topics that a list of papers lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Least coverage in percent of each level, and the level below all.
LEVELS = [
    (20, "★★★★★ Critical"),
    (10, "★★★★ High"),
    (5, "★★★ Medium"),
    (2, "★★ Low"),
    (1, "★ Very Low"),
]
LOWEST = "✩ Negligible"


def distribution(rows: DataFrame, key: str, most: int | None = None) -> DataFrame:
    """``(key, paper_count, percentage)``, commonest first; the share is of all rows with a key."""
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("paper_count"))
    total = counts.agg(F.sum("paper_count").alias("total"))
    share = F.bround(100.0 * F.col("paper_count") / F.col("total"), 2).alias("percentage")
    out = counts.crossJoin(F.broadcast(total)).select(key, "paper_count", share)  # one row
    return out.orderBy(F.desc("paper_count"), key).limit(most) if most else out


def describe(groups: DataFrame, details: DataFrame, key: str = "topic_id") -> DataFrame:
    """Groups with what is known of their topics; else the key as name and empty texts."""
    out = groups.join(details, key, "left")
    names = {"display_name": F.coalesce("display_name", key)}
    texts = {c: F.coalesce(c, F.lit("")) for c in ("description", "domain", "field", "subfield")}
    return out.withColumns(names | texts | {"keywords": F.coalesce(F.array_join("keywords", "; "), F.lit(""))})


def importance(coverage: Column) -> Column:
    out = None
    for least, name in LEVELS:
        out = (F if out is None else out).when(coverage >= least, F.lit(name))
    return out.otherwise(LOWEST)


def missing_topics(found: DataFrame, total: int | Column, current: DataFrame, key: str, order: str, example: str, attributes: tuple[str, ...] = ()) -> DataFrame:
    """Frequency, coverage, level and status of topics; the example is the first, attributes the last seen."""
    groups = found.groupBy(key).agg(
        F.count(F.lit(1)).alias("frequency"),
        F.min_by(example, order).alias("example"),
        *[F.max_by(a, order).alias(a) for a in attributes],
    )
    share = 100.0 * F.col("frequency") / (F.lit(total) if isinstance(total, int) else total)
    known = current.select(F.col(key).alias("_known")).distinct()
    out = groups.join(known, F.col(key) == F.col("_known"), "left")
    return out.withColumns(
        {
            "coverage": F.bround(share, 2),
            "importance": importance(share),
            "status": F.when(F.col("_known").isNotNull(), "Already Present").otherwise("NEW"),
        }
    ).drop("_known")
