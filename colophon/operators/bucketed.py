"""Tables in buckets of a key, changed bucket by bucket: copy on write.

A table is a folder of partitions by ``_bucket``, the key's hash; rows without a key are in a bucket of their own. A
delta reads and writes only the buckets that its keys fall in, by dynamic partition overwrite: files of other
buckets stay as they are. What is written is made and kept in the shared folder first, so a run that fails
before its commit leaves the table as it was.

Defined results: a row of the delta whose key is null is added, as it equals no other; of repeated keys in a delta
the first by ``order`` counts; an empty delta changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.operators.ingest import first_of
from colophon.storage import fixed

BUCKETS = 64


def bucket(key: str, buckets: int) -> Column:
    own = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets))
    return F.when(F.col(key).isNull(), buckets).otherwise(own).cast("int")


def _write(df: DataFrame, path: str) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket")
    writer.parquet(path)


def create(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """The table at ``path``; a large bucket is a few files, as its rows come from a few tasks."""
    placed = df.withColumn("_bucket", bucket(key, buckets))
    _write(placed.repartition("_bucket", F.pmod(F.xxhash64(*df.columns), F.lit(4))), path)


def read(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*[f"`{f.name}`" for f in schema])


def upsert(path: str, schema, delta: DataFrame, key: str, order: str, changes: dict[str, Callable[[Column, Column], Column]], buckets: int = BUCKETS) -> list[int]:
    """``delta`` merged into the table at ``path``; the buckets that were written.

    Rows whose key is there get, for each column in ``changes``, what it makes of the old and the new value;
    others are added, with the columns that the delta has. ``order`` is a column of the delta.
    """
    spark = delta.sparkSession
    names = [f.name for f in schema]
    known = delta.filter(F.col(key).isNotNull())
    rows = first_of(known, [key], [order]).unionByName(delta.filter(F.col(key).isNull())).withColumn("_bucket", bucket(key, buckets))
    rows = fixed(rows)
    touched = sorted(r["_bucket"] for r in rows.select("_bucket").distinct().collect())  # buckets + 1 at most
    if not touched:
        return []
    table = spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema)}, `_bucket` int").parquet(path)
    table = table.filter(F.col("_bucket").isin(touched))  # prunes folders
    new = rows.select(F.col("_bucket").alias("_at"), *[(F.col(n) if n in rows.columns else F.lit(None).cast(schema[n].dataType)).alias(f"_new_{n}") for n in names])
    joined = table.withColumn("_there", F.lit(True)).join(new, (F.col("_bucket") == F.col("_at")) & (F.col(key) == F.col(f"_new_{key}")), "full")
    there, hit = F.col("_there").isNotNull(), F.col("_at").isNotNull()

    def value(n: str) -> Column:
        old, given = F.col(n), F.col(f"_new_{n}")
        merged = changes[n](old, given) if n in changes else old
        return F.when(there & hit, merged).when(there, old).otherwise(given).alias(n)

    merged = fixed(joined.select(*map(value, names), F.coalesce("_bucket", "_at").alias("_bucket")))
    _write(merged.repartition("_bucket"), path)
    return touched
