"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    Inside a lambda a column is computed anew for every element, so long arrays are bound to a
    lambda variable first.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster, or one of our own where a local session names none (tests)."""
    context = spark.sparkContext
    found = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        found = tempfile.mkdtemp(prefix="colophon-checkpoint-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(found)
    return found


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of text in all rows; sizes the number of blocks."""
    return docs.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0
