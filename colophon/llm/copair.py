"""Co-bucketed table pair: rows of one key lie in files of one bucket, a file for each table and bucket.

``write_numbered`` lays a table out in numbered files. ``rewrite`` takes two tables so laid out by
anything and leaves each with one sorted file for each bucket of the key. Semi and anti joins tell
the right table's rows whose key the left one has from orphans, which take a bucket of their own,
as do rows without a key; ``repartitionById`` sends rows straight to their bucket's partition and each
partition that has rows becomes a file. A starting file that holds just the rows of one bucket stays.

The driver sees counts by starting file and bucket, whose number depends on the number of buckets
alone. A bucket is written by one task, which sorts with spilling; no join holds a hot key's rows
together (the left side has one row for each key, long runs of the right side can be split).

Defined results: repeated rows all stay; a left key that repeats counts for each of its rows in
``n_joined``; rows with a null key take the last bucket in both tables; an empty table has no
files; an empty text is a value like others and sorts after null; columns named like ours don't
clash. Of NaN and numbers NaN is the largest. New files are committed before starting files go, so
that a run which fails in between loses no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from colophon.llm.common import ensure_checkpoint_dir

#: Ids that are repeated at once while a file's ids are hashed.
CHUNK = 1 << 16


def crc_bucket(key: Column, buckets: int, salt: str = "") -> Column:
    """Unsigned CRC-32 of the salt and the key's decimal digits, modulo ``buckets``; null of null."""
    return F.pmod(F.crc32(F.concat(F.lit(salt), key.cast("string")).cast("binary")), F.lit(buckets)).cast("int")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fresh(name: str, columns: list[str]) -> str:
    """``name``, made longer until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def file_order(columns: list[str], key: str) -> list[Column]:
    """The key descending, then the other columns from left to right; nulls first."""
    rest = [F.col(quoted(c)).asc_nulls_first() for c in columns if c != key]
    return [F.col(quoted(key)).desc_nulls_first(), *rest]


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path under the shared folder of the session."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@dataclass
class Files:
    """Data files of a folder, by name; deleting and naming go through the folder's file system."""

    spark: SparkSession
    folder: str

    def __post_init__(self):
        self.root = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        self.system = self.root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def names(self) -> set[str]:
        if not self.system.exists(self.root):
            return set()
        return {n for s in self.system.listStatus(self.root) if (n := s.getPath().getName()).startswith("part-")}

    def path(self, name: str) -> str:
        """Its path; without the scheme if that is the session's own file system."""
        whole = self.system.makeQualified(self.spark._jvm.org.apache.hadoop.fs.Path(self.root, name))
        default = self.spark._jvm.org.apache.hadoop.fs.FileSystem.get(self.spark._jsc.hadoopConfiguration())
        return whole.toUri().getPath() if default.getUri().equals(self.system.getUri()) else whole.toString()

    def delete(self, name: str) -> None:
        self.system.delete(self.spark._jvm.org.apache.hadoop.fs.Path(self.root, name), False)


def write_numbered(df: DataFrame, number: str, parts: int, key: str, folder: str) -> set[str]:
    """Adds a sorted file for each value of the column ``number``, 0 to ``parts - 1``, that has rows.

    The number itself isn't written; it leads a file's name. Returns the names of the new files.
    """
    columns = [c for c in df.columns if c != number]
    files = Files(df.sparkSession, folder)
    before = files.names()
    dealt = df.repartitionById(parts, F.col(quoted(number))).sortWithinPartitions(*file_order(columns, key))
    writer = dealt.select(*map(quoted, columns)).write.mode("append")
    writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(folder)
    made = files.names() - before
    for first in sorted(n for n in made if int(n.split("-")[1]) == 0):  # written even if it has no rows
        if df.sparkSession.read.schema(df.select(*map(quoted, columns)).schema).parquet(f"{folder}/{first}").isEmpty():
            files.delete(first)
            made.remove(first)
    return made


def file_number(name: Column) -> Column:
    return F.regexp_extract(name, r"^part-(\d+)-", 1).cast("int")


def read_files(spark: SparkSession, schema: StructType, folder: str, names: set[str] | None = None) -> DataFrame:
    paths = [folder] if names is None else [f"{folder}/{n}" for n in sorted(names)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def with_file(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the number of the file each row comes from."""
    return df.withColumn(name, file_number(df.metadataColumn("_metadata")["file_name"]))


def flagged(rows: DataFrame, keys: DataFrame, key: str, bucket: str, buckets: int, salt: str) -> DataFrame:
    """``rows`` with their bucket: of the key if ``keys`` has it, ``buckets`` for orphans, one more for null keys."""
    at = F.col(quoted(key))
    have = rows.filter(at.isNotNull())
    only = keys.select(quoted(key)).hint("merge")
    known = have.join(only, key, "left_semi").withColumn(bucket, crc_bucket(at, buckets, salt))
    orphans = have.join(only, key, "left_anti").withColumn(bucket, F.lit(buckets))
    nulls = rows.filter(at.isNull()).withColumn(bucket, F.lit(buckets + 1))
    return known.unionByName(orphans).unionByName(nulls)


def own_bucket(rows: DataFrame, key: str, bucket: str, buckets: int, salt: str) -> DataFrame:
    return rows.withColumn(bucket, F.coalesce(crc_bucket(F.col(quoted(key)), buckets, salt), F.lit(buckets + 1)))


def staying(counts: dict[tuple[int, int], int]) -> dict[int, int]:
    """Starting files, by number, that hold all rows of a bucket and no others, with that bucket."""
    by_file: dict[int, int] = {}
    by_bucket: dict[int, int] = {}
    for (file, bucket), n in counts.items():
        by_file[file] = by_file.get(file, 0) + n
        by_bucket[bucket] = by_bucket.get(bucket, 0) + n
    return {f: b for (f, b), n in counts.items() if n == by_file[f] == by_bucket[b]}


def ids_digest(spark: SparkSession, schema: StructType, folder: str, key: str) -> DataFrame:
    """``(name, n_rows, sha256)`` of each file of a folder, over its keys as they lie in the file.

    Equal keys lie side by side, so a file's keys are read as runs and a hot key is one row here.
    """
    read = read_files(spark, StructType([schema[key]]), folder)
    meta = read.metadataColumn("_metadata")
    at = read.select(meta["file_name"].alias("name"), F.col(quoted(key)).cast("string").alias("id"), meta["row_index"].alias("at"))
    runs = at.groupBy("name", "id").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count(F.lit(1)).alias("n"))
    dealt = runs.repartition("name").sortWithinPartitions("name", "first")

    def digest(batches: Iterator) -> Iterator:
        import pyarrow as pa

        name, sha, rows = None, None, 0

        def done():
            return pa.RecordBatch.from_pydict({"name": [name], "n_rows": [rows], "sha256": [sha.hexdigest()]})

        for batch in batches:
            for file, key_text, first, last, n in zip(*(batch.column(c).to_pylist() for c in ("name", "id", "first", "last", "n"))):
                if file != name:
                    if name is not None:
                        yield done()
                    name, sha, rows = file, hashlib.sha256(), 0
                if last - first + 1 != n or first != rows:
                    raise ValueError(f"keys of {file} aren't in order at row {first}")
                one = (key_text or "").encode()
                sha.update(b"," * (rows > 0) + one)
                left = n - 1
                while left > 0:
                    sha.update((b"," + one) * min(left, CHUNK))
                    left -= CHUNK
                rows += n
        if name is not None:
            yield done()

    return dealt.mapInArrow(digest, "name string, n_rows long, sha256 string")


def rewrite(spark: SparkSession, folders: dict[str, str], schemas: dict[str, StructType], key: str, buckets: int, salt: str = "pair") -> DataFrame:
    """Rewrites the two tables in ``folders`` (left, then right) in place; a row for each final file.

    Columns: table_name, path, columns, ids_sha256, lineage_sha256, bucket, n_rows, n_joined, rewritten.
    """
    left, right = folders
    tables = {t: read_files(spark, schemas[t], folders[t]) for t in folders}
    ensure_checkpoint_dir(spark)
    own = F.col(quoted(key))
    keys = tables[left].filter(own.isNotNull()).groupBy(own.alias(key)).agg(F.count(F.lit(1)).alias("n_left_rows")).checkpoint()

    def bucketed(name: str, rows: DataFrame, bucket: str) -> DataFrame:
        if name == left:
            return own_bucket(rows, key, bucket, buckets, salt)
        return flagged(rows, keys, key, bucket, buckets, salt)

    met = tables[right].filter(own.isNotNull()).groupBy(own.alias(key)).agg(F.count(F.lit(1)).alias("n_right_rows"))
    met = met.join(keys.hint("merge"), key).groupBy(crc_bucket(own, buckets, salt).alias("bucket"))
    joined = {r["bucket"]: r["n"] for r in met.agg(F.sum(F.col("n_left_rows") * F.col("n_right_rows")).alias("n")).collect()}

    rows = []
    for name in folders:
        files, schema, columns = Files(spark, folders[name]), schemas[name], schemas[name].names
        bucket, file = fresh("_bucket", columns), fresh("_file", columns)
        placed = bucketed(name, with_file(tables[name].select(quoted(key), "_metadata"), file), bucket)
        found = placed.groupBy(file, bucket).agg(F.count(F.lit(1)).alias("n")).collect()
        counts = {(r[0], r[1]): r["n"] for r in found}
        stay = staying(counts)
        starting = files.names()
        numbers = {int(n.split("-")[1]): n for n in starting}
        moved = {n for f, n in numbers.items() if f not in stay and any(f == c for c, _ in counts)}
        made: set[str] = set()
        if moved:
            source = bucketed(name, read_files(spark, schema, folders[name], moved), bucket)
            made = write_numbered(source, bucket, buckets + 2, key, folders[name])
        for gone in starting - {numbers[f] for f in stay}:
            files.delete(gone)
        final = {numbers[f]: (b, False) for f, b in stay.items()} | {n: (int(n.split("-")[1]), True) for n in made}
        digests = {r["name"]: r for r in ids_digest(spark, schema, folders[name], key).collect()} if final else {}
        for n, r in digests.items():
            b, new = final[n]
            lineage = ",".join(f"{f}:{counts[f, b]}" for f in sorted(f for f, c in counts if c == b))
            rows.append((
                name, files.path(n), ",".join(columns), r["sha256"], hashlib.sha256(lineage.encode()).hexdigest(),
                b, r["n_rows"], joined.get(b, 0), new,
            ))
    kinds = "table_name string, path string, columns string, ids_sha256 string, lineage_sha256 string, bucket long, n_rows long, n_joined long, rewritten boolean"
    return spark.createDataFrame(rows, kinds)
