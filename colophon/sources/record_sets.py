"""Sets of text files that become visible whole: a data source writer for batches and streams.

Tasks write into a hidden folder; a commit renames it, which is one step, so readers see all of a set or
nothing. What attempts that failed have left is deleted before, and an abort deletes the folder. A
stream's sets are named by batch: a batch that is committed again after a restart changes nothing.

Paths may have any scheme that Arrow's file systems open on driver and executors.
"""

from __future__ import annotations

import csv
import io
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

FLUSH = 1 << 20


def opened(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    folder: str
    name: str
    rows: int


class _Writer:
    def __init__(self, path: str, form: str, columns: list[str], overwrite: bool = False):
        self.path, self.form, self.columns, self.overwrite = path, form, columns, overwrite
        self.run = uuid.uuid4().hex

    def hidden(self, name: str) -> str:
        return f"{self.path}/_{name}-{self.run}"

    def lines(self, rows):
        if self.form == "jsonl":
            for row in rows:
                yield json.dumps({c: row[c] for c in self.columns}, default=str, ensure_ascii=False) + "\n"
            return
        held = io.StringIO()
        writer = csv.writer(held, lineterminator="\n")
        writer.writerow(self.columns)
        for row in rows:
            writer.writerow(["" if row[c] is None else row[c] for c in self.columns])
            yield held.getvalue()
            held.seek(0)
            held.truncate()

    def put(self, rows, folder: str) -> Written:
        """One file; another attempt of the same task has another name. In a folder that is gone none is made."""
        system, path = opened(folder)
        name, count, held, size = f"part-{uuid.uuid4().hex}.{self.form}", 0, [], 0

        def counted():
            nonlocal count
            for row in rows:
                count += 1
                yield row

        with system.open_output_stream(f"{path}/{name}") as out:
            for line in self.lines(counted()):
                held.append(line)
                size += len(line)
                if size >= FLUSH:
                    out.write("".join(held).encode())
                    held, size = [], 0
            out.write("".join(held).encode())
        return Written(folder, name, count)

    def make(self, folder: str) -> None:
        system, path = opened(folder)
        system.create_dir(path)

    def show(self, messages: list, name: str) -> None:
        """The set becomes visible under its name; a set that is there already stays."""
        from pyarrow import fs

        system, root = opened(self.path)
        kept = {m.name for m in messages if m is not None and m.rows}
        if self.overwrite:
            for found in system.get_file_info(fs.FileSelector(root)):
                if found.base_name.startswith("set-"):
                    system.delete_dir(found.path)
        for folder in {m.folder for m in messages if m is not None}:
            _, staged = opened(folder)
            for found in system.get_file_info(fs.FileSelector(staged)):
                if found.base_name not in kept:
                    system.delete_file(found.path)
            if kept and system.get_file_info(f"{root}/{name}").type == fs.FileType.NotFound:
                system.move(staged, f"{root}/{name}")
            else:
                system.delete_dir(staged)

    def drop(self, hidden: str) -> None:
        from pyarrow import fs

        system, staged = opened(hidden)
        if system.get_file_info(staged).type != fs.FileType.NotFound:
            system.delete_dir(staged)


class _Batch(_Writer, DataSourceWriter):
    """The driver makes the folder, so that a task that outlives an abort can't make it again."""

    def __init__(self, *given):
        super().__init__(*given)
        self.make(self.hidden("set"))

    def write(self, iterator):
        return self.put(iterator, self.hidden("set"))

    def commit(self, messages):
        self.show(messages, f"set-{self.run}")
        self.drop(self.hidden("set"))

    def abort(self, messages):
        self.drop(self.hidden("set"))


class _Stream(_Writer, DataSourceStreamWriter):
    """Each epoch's files lie in one hidden folder until the epoch is committed."""

    def write(self, iterator):
        self.make(self.hidden("epoch"))
        return self.put(iterator, self.hidden("epoch"))

    def commit(self, messages, batchId):
        self.show(messages, f"set-batch-{batchId:012d}")

    def abort(self, messages, batchId):
        for folder in {m.folder for m in messages if m is not None} | {self.hidden("epoch")}:
            self.drop(folder)


class RecordSets(DataSource):
    """Format ``record_sets``; options ``path`` and ``form``, ``jsonl`` (nulls written out) or ``csv`` (with a header)."""

    @classmethod
    def name(cls):
        return "record_sets"

    def _given(self, schema) -> tuple[str, str, list[str]]:
        form = self.options.get("form", "jsonl")
        if form not in ("jsonl", "csv"):
            raise ValueError(f"a form is jsonl or csv, not {form!r}")
        return self.options["path"].rstrip("/"), form, schema.names

    def writer(self, schema, overwrite):
        return _Batch(*self._given(schema), overwrite)

    def streamWriter(self, schema, overwrite):
        return _Stream(*self._given(schema))


def write_set(df: DataFrame, path: str, form: str = "jsonl", mode: str = "append") -> None:
    df.sparkSession.dataSource.register(RecordSets)
    df.write.format("record_sets").mode(mode).option("form", form).save(path)


def stream_sets(stream: DataFrame, path: str, checkpoint: str, form: str = "jsonl"):
    """A query that writes all there is, one set for each batch."""
    stream.sparkSession.dataSource.register(RecordSets)
    writer = stream.writeStream.format("record_sets").option("form", form).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(path)


def read_sets(spark: SparkSession, path: str, schema: str, form: str = "jsonl") -> DataFrame:
    """The rows of all sets that are committed."""
    reader = spark.read.schema(schema)
    reader = reader.option("header", True).option("multiLine", True).option("escape", '"') if form == "csv" else reader
    return (reader.csv if form == "csv" else reader.json)(f"{path}/set-*")
