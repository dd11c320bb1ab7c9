"""Counts that are taken while tables are made, in the same pass.

A step's rows are observed on their way: Spark adds up the metrics in the tasks that make them, so a
count costs no job of its own, and a dry run is the same plan without a sink.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from colophon.storage import fixed


class RunStats:
    """The observed steps of a run, by name, in their order."""

    def __init__(self):
        self.steps: dict[str, Observation] = {}

    def watch(self, step: str, df: DataFrame, **metrics: Column) -> DataFrame:
        """``df`` whose ``rows``, and the sums given, are counted when it is made for the first time."""
        if step in self.steps:
            raise ValueError(f"{step} is watched already")
        self.steps[step] = Observation()
        return df.observe(self.steps[step], F.count(F.lit(1)).alias("rows"), *(m.alias(n) for n, m in metrics.items()))

    def watched(self, step: str, df: DataFrame, **metrics: Column) -> DataFrame:
        """``df`` made now, once, and its counts; for steps that several tables are made of."""
        return fixed(self.watch(step, df, **metrics))

    def counts(self) -> dict[str, dict[str, int]]:
        """What the steps counted; to be asked when all watched tables are made."""
        return {step: dict(seen.get) for step, seen in self.steps.items()}

    def lines(self) -> list[str]:
        return [f"{step}: " + ", ".join(f"{n} {v or 0}" for n, v in found.items()) for step, found in self.counts().items()]


def watched(stats: RunStats | None, step: str, df: DataFrame, **metrics: Column) -> DataFrame:
    """As ``RunStats.watched``; without statistics the table as it is."""
    return stats.watched(step, df, **metrics) if stats else df


def without_sink(df: DataFrame) -> None:
    """Makes all rows of a table and keeps none."""
    df.write.format("noop").mode("overwrite").save()
