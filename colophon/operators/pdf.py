"""First pages of papers: fetched once into a cache table, their text, and what is read from it."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.functions.normalize import pdf_cache_name
from colophon.operators.enrich import orcid_key
from colophon.operators.impute import audit, clean_predictions, fill_nulls, insert_absent, papers_lacking, resolved
from colophon.operators.matching import align_authors

MOST_BYTES = 30 << 20
#: ``get(url)`` gives an HTTP code, a content type and the body in parts; it raises ``OSError`` without an answer.
Get = Callable[[str], tuple[int, str, Iterable[bytes]]]
CACHE = "name string, doi string, content binary, error string"


def fetched(get: Get, url: str, most_bytes: int = MOST_BYTES) -> tuple[bytes | None, str | None]:
    """``(content, error)``; errors are ``http_N``, ``not_pdf``, ``too_large`` and ``network``."""
    try:
        code, kind, parts = get(url)
        if code >= 400:
            return None, f"http_{code}"
        if not re.search("pdf|application/octet-stream", (kind or "").lower()):
            return None, "not_pdf"
        body = bytearray()
        for part in parts:
            body += part
            if len(body) > most_bytes:
                return None, "too_large"
        return bytes(body), None
    except OSError:
        return None, "network"


def with_cache(urls: DataFrame, get: Get, path: str, most_bytes: int = MOST_BYTES, skip_cache: bool = False) -> DataFrame:
    """``(name, doi, content, error)`` for ``(doi, url)``; what was fetched before is not asked for again.

    The cache is a table at ``path``, a row for each file. Failures are not kept, so they are tried again.
    """
    spark = urls.sparkSession
    asked = urls.select("doi", "url", pdf_cache_name(F.col("doi")).alias("name")).dropDuplicates(["name"])
    try:
        have = spark.read.schema(CACHE).parquet(path)
        have.limit(1).count()
    except Exception as error:  # no cache yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
        have = spark.createDataFrame([], CACHE)
    new = asked if skip_cache else asked.join(have, "name", "left_anti")

    def run(frames: Iterator) -> Iterator:
        for frame in frames:
            for name, doi, url in zip(frame["name"], frame["doi"], frame["url"]):
                yield pd.DataFrame([(name, doi, *fetched(get, url, most_bytes))], columns=["name", "doi", "content", "error"])

    found = new.filter("url is not null").select("name", "doi", "url").mapInPandas(run, CACHE).checkpoint()
    found.filter("error is null").write.mode("append").parquet(path)
    old = have.join(asked.select("name"), "name", "left_semi").join(found.select("name"), "name", "left_anti")
    return found.unionByName(old.dropDuplicates(["name"]).select(*found.columns))


def _objects(data: bytes) -> dict[int, bytes]:
    """A file's numbered objects, those in compressed streams too."""
    found = {int(m[1]): m[2] for m in re.finditer(rb"(\d+)\s+\d+\s+obj\b(.*?)\bendobj", data, re.S)}
    for body in list(found.values()):
        if re.search(rb"/Type\s*/ObjStm", body[:400]):
            text = _stream(body)
            first = int(re.search(rb"/First\s+(\d+)", body)[1])
            numbers = [int(x) for x in text[:first].split()]
            places = [*numbers[1::2], len(text) - first]
            for n, a, b in zip(numbers[::2], places, places[1:]):
                found.setdefault(n, text[first + a : first + b])
    return found


def _stream(body: bytes) -> bytes:
    m = re.search(rb"stream\r?\n(.*?)\r?\n?endstream", body, re.S)
    if not m:
        return b""
    return zlib.decompressobj().decompress(m[1]) if b"FlateDecode" in body[: m.start()] else m[1]


def _references(body: bytes, name: bytes) -> list[int]:
    m = re.search(name + rb"\s*(\[[^\]]*\]|\d+\s+\d+\s+R)", body)
    return [int(n) for n in re.findall(rb"(\d+)\s+\d+\s+R", m[1])] if m else []


_TOKEN = re.compile(rb"\((?:\\.|[^\\()]|\((?:\\.|[^\\()])*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|[-+.\d]+|/?[A-Za-z*'\"]+", re.S)
_ESCAPED = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def _string(token: bytes) -> str:
    if token[:1] == b"<":
        digits = re.sub(rb"\s", b"", token[1:-1])
        raw = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
        return raw.decode("utf-16-be", "ignore") if raw[:1] == b"\0" and len(raw) % 2 == 0 else raw.decode("cp1252", "ignore")
    plain = re.sub(rb"\\([0-7]{1,3}|\r?\n|.)", lambda m: bytes([int(m[1], 8) & 255]) if m[1].isdigit() else _ESCAPED.get(m[1], m[1].strip(b"\r\n")), token[1:-1], flags=re.S)
    return plain.decode("cp1252", "ignore")


def _shown(content: bytes) -> str:
    out, held = [], []
    for token in _TOKEN.findall(content):
        if token[:1] in (b"(", b"<"):
            held.append(_string(token))
        elif re.fullmatch(rb"-\d{3,}(\.\d+)?", token):
            held.append(" ")  # a wide gap inside an array of strings
        elif token in (b"Tj", b"TJ"):
            out.append("".join(held))
            held = []
        elif token in (b"Td", b"TD", b"T*", b"ET", b"'", b'"'):
            out += ["\n", *held] if token in (b"'", b'"') else ["\n"]
            held = []
        elif token.isalpha():
            held = []
    return re.sub(r"[ \t]*\n\s*", "\n", "".join(out)).strip()


def first_page_text(content: bytes | None) -> str:
    """The text layer of a file's first page; empty if it has none or can't be read.

    Fonts with encodings of their own come out as they are stored; pass another reader for these.
    """
    try:
        found = _objects(content or b"")
        node = next(body for body in found.values() if re.search(rb"/Type\s*/Pages\b", body) and b"/Parent" not in body)
        for _ in range(64):
            if not re.search(rb"/Type\s*/Pages\b", node):
                break
            node = found[_references(node, rb"/Kids")[0]]
        return _shown(b"\n".join(_stream(found[n]) for n in _references(node, rb"/Contents")))
    except (StopIteration, KeyError, IndexError, ValueError, TypeError, zlib.error):
        return ""


def texts(files: DataFrame, read: Callable[[bytes | None], str] = first_page_text) -> DataFrame:
    """``files`` with ``text`` in place of their content."""
    def run(contents: pd.Series) -> pd.Series:
        return contents.map(lambda c: read(None if c is None else bytes(c)))

    return files.withColumn("text", F.pandas_udf(run, "string")("content")).drop("content")


AUTHORS = "paper_id string, pos int, given string, family string, orcid string, institution_name string, country_code string, confidence double"


def predicted_authors(pages: DataFrame, predictor: Callable[[str], list[dict]]) -> DataFrame:
    """``AUTHORS`` from ``(paper_id, text)``; ``predictor(text)`` lists dicts with ``position``, ``institution`` and so on."""

    def run(frames: Iterator) -> Iterator:
        for frame in frames:
            rows = []
            for paper, text in zip(frame["paper_id"], frame["text"]):
                said = predictor(text) if (text or "").strip() else []
                for a in said:
                    if a.get("position") is not None:
                        names = (a.get(k) for k in ("given", "family", "orcid", "institution", "country_code"))
                        rows.append((paper, int(a["position"]), *names, float(a.get("confidence") or 0)))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in AUTHORS.split(", ")])

    return pages.select("paper_id", "text").mapInPandas(run, AUTHORS)


def from_pdf(tables: dict[str, DataFrame], said: DataFrame, least: float = 0.0, names: DataFrame | None = None, threshold: float = 0.78):
    """Institutions and countries of the authors on first pages: ``(tables, audit)``.

    Rows of papers that lack an institution are aligned with ``said`` by ORCID, else by place.
    """
    contributions, authors = tables["contributions"], tables["authors"]
    gaps = papers_lacking(tables["papers"], contributions).select(F.col("id").alias("paper_id"))
    known = authors.select(F.col("id").alias("author_id"), orcid_key(F.col("orcid")).alias("orcid"))
    targets = contributions.join(gaps, "paper_id", "left_semi").join(said.select("paper_id").distinct(), "paper_id", "left_semi")
    targets = targets.join(known, "author_id", "left").select("paper_id", "row_id", "orcid")
    others = said.withColumn("orcid", orcid_key(F.col("orcid")))
    aligned = align_authors(targets, others.select("paper_id", "pos", "orcid")).filter("other_pos is not null")
    pairs = aligned.join(others.drop("orcid").withColumnRenamed("pos", "other_pos"), ["paper_id", "other_pos"])
    sure = clean_predictions(pairs, "row_id", least).filter("institution_name is not null or country_code is not null")
    found, made = resolved(sure, tables["institutions"], names, threshold)
    log = audit(found.withColumn("matched_terms", F.concat_ws(" | ", "method", "institution_name")), "pdf", "pdf")
    out = fill_nulls(contributions, found, "row_id", ["institution_id", "country_code"])
    return tables | {"contributions": out, "institutions": insert_absent(tables["institutions"], made, ["id"])}, log
