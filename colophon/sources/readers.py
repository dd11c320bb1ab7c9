"""Files that come in: work records, spreadsheets' exports, lists."""

from __future__ import annotations

import csv
import io
from html.parser import HTMLParser

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.operators.wos import NULL_TOKENS, null_tokens
from colophon.schemas import WORK
from colophon.sources.sheets import workbook

ENCODINGS = ("utf-8", "utf-8-sig", "windows-1252", "iso8859-1")
ZIP_MAGIC, OLE_MAGIC = b"PK\x03\x04", b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"
BYTES_PER_RECORD = 8700
SAMPLE = 4096


def works(spark: SparkSession, path: str) -> DataFrame:
    """Work records of JSON lines, with file and place for their order; bad lines have ``_corrupt_record``."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"))
    return parsed_works(lines.withColumn("_line", F.monotonically_increasing_id()))


def parsed_works(lines: DataFrame) -> DataFrame:
    """Work records from ``value, _file, _line``; blank lines go.

    The record is exploded from an array of one: filters on columns are not moved below that, where each would parse it anew.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = lines.filter(F.trim("value") != "").select(F.explode(F.array(F.from_json("value", WORK, options))).alias("w"), "_file", "_line")
    return parsed.select("w.*", "_file", "_line")


def load_counts(records: DataFrame) -> DataFrame:
    """``(read, errors)``."""
    return records.agg(F.count(F.lit(1)).alias("read"), F.count("_corrupt_record").alias("errors"))


def table_csv(spark: SparkSession, path: str, tokens: list[str] = NULL_TOKENS, needs: tuple[str, ...] = ("DOI",), **options) -> DataFrame:
    """A CSV with header, all columns as text, null for each of ``tokens``; ``needs`` must be there."""
    rows = spark.read.options(header=True, multiLine=True, escape='"', **options).csv(path)
    lacking = [c for c in needs if c not in rows.columns]
    if lacking:
        raise ValueError(f"{path} lacks {', '.join(lacking)}")
    return null_tokens(rows, tokens)


def doi_list(spark: SparkSession, path: str) -> DataFrame:
    """``(doi, pos)``: the first DOI of each line in order, repeated ones once."""
    lines = spark.read.text(path).withColumn("pos", F.monotonically_increasing_id())
    found = F.rtrim(F.regexp_extract("value", r"10\.\S+", 0), F.lit(".,;)]}>"))
    rows = lines.select(found.alias("doi"), "pos").filter("doi <> ''")
    return rows.groupBy("doi").agg(F.min("pos").alias("pos"))


def setting_lines(text: str) -> list[str]:
    """Lines of a settings file without comments and blanks."""
    return [line.strip() for line in text.splitlines() if line.strip() and not line.strip().startswith("#")]


def head(spark: SparkSession, path: str, size: int = SAMPLE) -> bytes:
    """First bytes of a file, wherever Spark can read it."""
    row = spark.read.format("binaryFile").load(path).select(F.substring("content", 1, size).alias("c")).first()
    return bytes(row["c"]) if row else b""


def encoding_of(sample: bytes) -> str:
    for name in ENCODINGS:
        try:
            sample.decode(name)
            return name
        except UnicodeDecodeError as error:
            if name.startswith("utf-8") and len(sample) >= SAMPLE and error.start >= len(sample) - 3:
                return name  # a character cut off by the sample's end
    return ENCODINGS[-1]


def delimiter_of(sample: str) -> str:
    try:
        return csv.Sniffer().sniff(sample, ",\t;|").delimiter
    except csv.Error:
        return ","


def kind_of(sample: bytes) -> str:
    """``excel``, ``html`` or ``text``, by content."""
    if sample.startswith((ZIP_MAGIC, OLE_MAGIC)):
        return "excel"
    text = sample.decode(encoding_of(sample), "replace").lstrip("﻿ \t\r\n").lower()
    return "html" if text.startswith("<") and "<table" in text else "text"


class _Tables(HTMLParser):
    """Cells of all tables, in the order in which tables open; what isn't closed ends with what is around it."""

    def __init__(self):
        super().__init__()
        self.tables: list[list[list[str]]] = []
        self.open: list[list[list[str]]] = []
        self.cells: list[list[str] | None] = []

    def _close_cell(self) -> None:
        if self.open and self.cells[-1] is not None:
            self.open[-1][-1].append(" ".join("".join(self.cells[-1]).split()))
            self.cells[-1] = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.tables.append([])
            self.open.append(self.tables[-1])
            self.cells.append(None)
        elif tag == "tr" and self.open:
            self._close_cell()
            self.open[-1].append([])
        elif tag in ("td", "th") and self.open:
            self._close_cell()
            if not self.open[-1]:
                self.open[-1].append([])
            self.cells[-1] = []

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr") and self.open:
            self._close_cell()
        elif tag == "table" and self.open:
            self._close_cell()
            self.open.pop()
            self.cells.pop()

    def handle_data(self, data):
        if self.cells and self.cells[-1] is not None:
            self.cells[-1].append(data)

    def close(self):
        super().close()
        while self.open:
            self.handle_endtag("table")


def html_tables(html: str | None) -> list[list[list[str]]]:
    """The cells of each table of a page, row by row; tables within tables are tables of their own."""
    parser = _Tables()
    parser.feed(html or "")
    parser.close()
    return parser.tables


class HtmlCells:
    """A table function: ``(tbl, row, col, text)`` of every cell of a page, counted from 0; rows without cells count."""

    def eval(self, html: str):
        for t, rows in enumerate(html_tables(html)):
            for r, cells in enumerate(rows):
                for c, text in enumerate(cells):
                    yield t, r, c, text


def html_cells(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with a row for each cell of their tables; pages without cells go, and so do columns named as the cell's."""
    spark = pages.sparkSession
    spark.udtf.register("html_cells", F.udtf(HtmlCells, returnType="tbl int, row int, col int, text string"))
    kept = [c for c in pages.columns if c.lower() not in ("tbl", "row", "col", "text")]
    chosen = ", ".join([*(f"p.`{c}`" for c in kept if c != html), "c.tbl", "c.row", "c.col", "c.text"])
    return spark.sql(f"SELECT {chosen} FROM {{p}} AS p, LATERAL html_cells(p.`{html}`) AS c", p=pages)


def largest_table(html: str) -> list[list[str]]:
    """Cells of the table with most cells; the first of equals."""
    return max(html_tables(html), key=lambda t: sum(map(len, t)), default=[])


def sniffed(spark: SparkSession, path: str) -> DataFrame:
    """A table from a delimited or HTML file or a spreadsheet, by its content."""
    sample = head(spark, path)
    kind = kind_of(sample)
    if kind == "excel":
        return workbook(spark, path)
    encoding = encoding_of(sample)
    if kind == "text":
        first = sample.decode(encoding, "replace").lstrip("﻿")
        name = {"utf-8-sig": "utf-8"}.get(encoding, encoding)
        return spark.read.options(header=True, sep=delimiter_of(first), encoding=name, multiLine=True, escape='"').csv(path)
    body = spark.read.format("binaryFile").load(path).select("content").first()["content"]
    rows = largest_table(bytes(body).decode(encoding, "replace"))
    names, rest = (rows[0], rows[1:]) if rows else ([], [])
    schema = ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame([tuple((r + [None] * len(names))[: len(names)]) for r in rest], schema)


def csv_text(rows: list[dict], columns: list[str]) -> str:
    out = io.StringIO()
    writer = csv.DictWriter(out, columns)
    writer.writeheader()
    writer.writerows(rows)
    return out.getvalue()


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One CSV file with header, for reports."""
    df.coalesce(1).write.mode(mode).option("header", True).csv(path)


def size_estimate(records: int, free_bytes: int) -> tuple[int, bool]:
    """Bytes that so many records take, and whether twice that is free."""
    need = records * BYTES_PER_RECORD
    return need, free_bytes >= 2 * need
