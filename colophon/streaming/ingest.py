"""Work records taken in as they come; the checkpoint remembers what was done."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Parts by a key's hash that a batch's repeats meet in, so that a task holds one part at once and not its whole share.
PARTS = 4096


def first_rows(stream: DataFrame, key: str, order: str) -> DataFrame:
    """The stream's first row of each key, null keys left out; in a batch the least by ``order``, null last.

    A key's state is one entry in the state store, beside the rows of the same key: a batch reads
    and writes the state of its own keys, never the table that is there. Repeats within a batch meet
    before the state is asked, in Arrow, part by part; the state itself needs no Python.
    """

    def least(rows):
        import pyarrow as pa
        import pyarrow.compute as pc

        rows = rows.drop_columns("_part")
        at = pc.sort_indices(rows, sort_keys=[(key, "ascending"), (order, "ascending")], null_placement="at_end")
        rows = rows.take(at)
        keys = rows.column(key).combine_chunks()
        new = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1))
        return rows.filter(pa.concat_arrays([pa.array([True]), new]))

    rows = stream.filter(F.col(key).isNotNull()).withColumn("_part", F.pmod(F.xxhash64(key), F.lit(PARTS)))
    return rows.groupBy("_part").applyInArrow(least, stream.schema).dropDuplicates([key])


@contextmanager
def stateful(spark: SparkSession):
    """The session with the state store that keyed state needs."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def ingest_stream(stream: DataFrame, path: str, checkpoint: str, key: str, order: str):
    """A query that takes in all there is: first writer wins over all batches and starts on one checkpoint."""
    with stateful(stream.sparkSession):
        writer = first_rows(stream, key, order).writeStream.option("checkpointLocation", checkpoint)
        return writer.outputMode("append").trigger(availableNow=True).format("parquet").start(path)


def read_json_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).json(path)
