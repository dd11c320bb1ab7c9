"""Where intermediate results go."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, or one of our own where a local session names none (tests)."""
    context = spark.sparkContext
    found = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        found = tempfile.mkdtemp(prefix="colophon-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(found)
    return found


def fixed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder as Parquet: smaller than ``fixed``, and readers take the columns they need.

    It has no partitions or order of its own afterwards.
    """
    checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/kept-{uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join that is never broadcast.

    Sizes are guessed from the input files; rows made from them can be many times as large, and the driver would hold
    them whole.
    """
    return df.hint("merge")
