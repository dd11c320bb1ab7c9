"""Spreadsheets in the zipped XML format, read where they lie, a file a task."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.functions.country import AGGREGATE_FILES, country_of_file

CELLS = "path string, row long, cells map<string, string>"


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _column(reference: str) -> int:
    """Number of a cell's column, from 0: letters are digits to the base 26."""
    n = 0
    for letter in re.match(r"[A-Z]*", reference)[0]:
        n = 26 * n + ord(letter) - ord("A") + 1
    return n - 1


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter() if _local(t.tag) == "t")


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """The first sheet's rows as texts; whole numbers without a fraction, empty cells null."""
    book = zipfile.ZipFile(io.BytesIO(content))
    names = set(book.namelist())
    shared = []
    if "xl/sharedStrings.xml" in names:
        root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
        shared = [_text(x) for x in root if _local(x.tag) == "si"]
    sheets = sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.sub(r"\D", "", n)))
    if not sheets:
        return
    for _, row in ElementTree.iterparse(book.open(sheets[0])):
        if _local(row.tag) != "row":
            continue
        values: list[str | None] = []
        for cell in row:
            kind = cell.get("t")
            found = next((x.text for x in cell if _local(x.tag) == "v"), None)
            if kind == "s" and found is not None:
                found = shared[int(found)]
            elif kind == "inlineStr":
                found = _text(cell)
            elif kind is None and found is not None and re.fullmatch(r"-?\d+\.0+", found):
                found = found.partition(".")[0]
            at = _column(cell.get("r") or "") if cell.get("r") else len(values)
            values += [None] * (at + 1 - len(values))
            values[at] = found if found else None
        yield values
        row.clear()


def sheet_cells(files: DataFrame) -> DataFrame:
    """``(path, row, cells)`` of ``(path, content)``: rows below the header, cells by its names."""

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                rows = sheet_rows(content)
                header = next(rows, [])
                made = [(path, k, {n: v for n, v in zip(header, r) if n and v is not None}) for k, r in enumerate(rows, 1) if any(r)]
                yield pd.DataFrame(made, columns=["path", "row", "cells"])

    return files.select("path", "content").mapInPandas(run, CELLS)


def workbook(spark: SparkSession, path: str) -> DataFrame:
    """A spreadsheet's first sheet as a table of texts."""
    content = bytes(spark.read.format("binaryFile").load(path).select("content").first()["content"])
    if not content.startswith(b"PK"):
        raise ValueError(f"{path} is a spreadsheet of the old binary format; save it as xlsx or CSV")
    rows = sheet_rows(content)
    header = [n or f"column{k}" for k, n in enumerate(next(rows, []))]
    kept = [tuple((r + [None] * len(header))[: len(header)]) for r in rows if any(r)]
    return spark.createDataFrame(kept, ", ".join(f"`{n}` string" for n in header) or "empty string")


def country_sheets(
    spark: SparkSession, folder: str, columns: list[str], only: str | None = None, most_files: int | None = None, most_rows: int | None = None
) -> DataFrame:
    """Rows of a folder's country files with ``columns``, ``country_code`` and ``ordinal``, by file name and row.

    Files of aggregates or without a country go; ``only`` names a single one.
    """
    if only in AGGREGATE_FILES:
        raise ValueError(f"{only} holds several countries")
    files = spark.read.format("binaryFile").option("pathGlobFilter", only or "*.xlsx").load(folder)
    files = files.select(F.url_decode("path").alias("path"), "content")
    files = files.withColumn("country_code", country_of_file(F.col("path"))).filter("country_code is not null")
    if most_files is not None:
        names = files.select("path").orderBy("path").limit(most_files)
        files = files.join(names, "path", "left_semi")
    order = files.select("path").orderBy("path").collect()  # names of files alone
    places = spark.createDataFrame([(r["path"], k) for k, r in enumerate(order)], "path string, file long")
    cells = sheet_cells(files)
    if most_rows is not None:
        cells = cells.filter(F.col("row") <= most_rows)
    found = cells.join(F.broadcast(places), "path").withColumn("country_code", country_of_file(F.col("path")))
    ordinal = (F.col("file") * (1 << 24) + F.col("row")).alias("ordinal")  # a sheet has at most 2 ** 20 rows
    return found.select(*[F.col("cells")[c].alias(c) for c in columns], "country_code", ordinal)
