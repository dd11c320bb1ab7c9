"""Keys and texts brought to one form, as columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Forms of DOIs.
DOI_PREFIX = r"^(https://doi\.org/|http://doi\.org/|doi:)"
DOI_PREFIX_ANY = r"(?i)^(https?://(dx\.)?doi\.org/|doi:)"
DOI_FORM = r"^10\.\d{4,9}/\S+$"


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once: inside a lambda a column is computed anew for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip_space(x: Column) -> Column:
    """Without white space at either end (``trim`` knows the space alone)."""
    return F.regexp_replace(x, r"^\s+|\s+$", "")


def blank_to_null(x: Column) -> Column:
    return F.when(x != "", x)


def not_blank(x: Column) -> Column:
    """Neither null nor spaces alone; false, not null, for null."""
    return F.coalesce(F.trim(x) != "", F.lit(False))


def doi_key(x: Column) -> Column:
    """Join key of a DOI: lower case, one URL or ``doi:`` prefix off, empty as null."""
    return blank_to_null(F.regexp_replace(F.lower(strip_space(x)), DOI_PREFIX, ""))


def doi_checked(x: Column) -> Column:
    """Lower-case DOI, or null where it isn't one."""
    bare = F.lower(strip_space(F.regexp_replace(strip_space(x), DOI_PREFIX_ANY, "")))
    return F.when(bare.rlike(DOI_FORM), bare)


def doi_bare(x: Column) -> Column:
    """DOI without prefix, its case kept; null as empty."""
    return F.coalesce(F.regexp_replace(strip_space(x), r"(?i)^(https?://doi\.org/|doi:)", ""), F.lit(""))


class Unmarked(dict):
    """For each character what is left of its decomposition without combining marks.

    Marks only change places among themselves when whole texts are decomposed, so characters can be taken one by one.
    """

    def __missing__(self, code: int) -> str:
        import unicodedata

        found = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        self[code] = found
        return found


_UNMARKED = Unmarked()


def _decomposed(text: str) -> str:
    return text if text.isascii() else text.translate(_UNMARKED)


def _composed(text: str) -> str:
    import unicodedata

    return unicodedata.normalize("NFKC", text).casefold()


#: Texts, and bytes of texts, that are Python strings at once.
TEXTS, TEXT_BYTES = 256, 1 << 20


def _in_parts(values: pa.Array, change: Callable[[str], str]) -> Iterator[pa.Array]:
    """``change`` of each text of an Arrow array, a few texts at a time: the rest of a batch stays in Arrow."""
    at, count = 0, TEXTS
    while at < len(values):
        part = values.slice(at, count)
        if count > 1 and part.nbytes > TEXT_BYTES:
            count = max(1, count // 2)
            continue
        yield pa.array([None if t is None else change(t) for t in part.to_pylist()], pa.string())
        at, count = at + count, min(TEXTS, count * 2)


def _by_batch(change: Callable[[str], str], x: Column) -> Column:
    """``change`` of each text in Arrow batches: Spark has no function for Unicode forms.

    Parts go back as they are done, so Python holds a batch as it came and one part, never two batches of strings.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            yield from _in_parts(values, change)

    return F.arrow_udf(run, "string")(x)


def fold_marks(x: Column) -> Column:
    """Decomposed and without combining marks."""
    return _by_batch(_decomposed, x)


def fold_case(x: Column) -> Column:
    """Compatibility-composed and case-folded."""
    return _by_batch(_composed, x)


def _words_only(x: Column, others: str) -> Column:
    return F.btrim(F.regexp_replace(x, others, " "), F.lit(" "))


def title_key(x: Column) -> Column:
    """Title as a match key: no marks, lower case, letters, digits and ``_`` alone; empty as null."""
    return blank_to_null(_words_only(F.lower(fold_marks(x)), r"[^\p{L}\p{N}_]+"))


def title_loose(x: Column) -> Column:
    """Title compared without case, ASCII punctuation and spacing; null as empty."""
    return F.coalesce(_words_only(fold_case(x), r"[\s!-/:-@\[-`{-~]+"), F.lit(""))


def last_segment(x: Column) -> Column:
    """Text after the last slash; empty as null."""
    return blank_to_null(F.element_at(F.split(x, "/"), -1))


def country_code(x: Column) -> Column:
    """Upper case, trimmed, blank as null, Hong Kong as China."""
    code = F.upper(strip_space(x))
    return F.when(code == "HK", F.lit("CN")).when(code != "", code)


def abstract_text(index: Column) -> Column:
    """Words of an inverted index (word to positions) in order; all words of one position stay."""
    pairs = F.flatten(
        F.transform(
            F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))
        )
    )
    return F.coalesce(F.array_join(F.transform(F.array_sort(pairs), lambda s: s["w"]), " "), F.lit(""))


def abstract_last(index: Column) -> Column:
    """As ``abstract_text``, but the last word of a position wins, and no words give null."""
    places = F.transform(
        F.map_entries(index), lambda e, i: F.transform(e["value"], lambda p: F.struct(p.alias("p"), i.alias("i"), e["key"].alias("w")))
    )

    def words(ordered: Column) -> Column:
        last = F.filter(ordered, lambda s, i: (i == F.size(ordered) - 1) | (F.get(ordered, i + 1)["p"] != s["p"]))
        return F.array_join(F.transform(last, lambda s: s["w"]), " ")

    return F.when(F.size(index) > 0, once(F.array_sort(F.flatten(places)), words))


def first_not_blank(values: Column) -> Column:
    return F.get(F.filter(values, lambda v: not_blank(v)), F.lit(0))


def is_international(countries: Column) -> Column:
    return F.coalesce(countries, F.lit(0)) > 1


def synthetic_institution_id(name: Column) -> Column:
    folded = F.lower(F.btrim(F.regexp_replace(name, r"\s+", " "), F.lit(" ")))
    return F.concat(F.lit("IMP_"), F.substring(F.sha1(folded), 1, 10))


def stub_id(accession: Column, title: Column) -> Column:
    """Id of a paper that only a spreadsheet knows: its accession number, else a hash of its title."""
    number = blank_to_null(strip_space(F.replace(accession, F.lit("WOS:"), F.lit(""))))
    digest = F.substring(F.sha1(F.lower(strip_space(F.coalesce(title, F.lit(""))))), 1, 12)
    return F.coalesce(F.concat(F.lit("WOS_"), number), F.concat(F.lit("WOS_T"), digest))


def arxiv_id(doi: Column) -> Column:
    bare = doi_bare(doi)
    return F.when(F.lower(bare).startswith("10.48550/arxiv."), blank_to_null(F.substring(bare, len("10.48550/arxiv.") + 1, 1000)))


def arxiv_pdf_url(doi: Column) -> Column:
    return F.concat(F.lit("https://arxiv.org/pdf/"), arxiv_id(doi), F.lit(".pdf"))


def pdf_cache_name(doi: Column) -> Column:
    return F.concat(F.sha1(doi), F.lit(".pdf"))


def text_metrics(text: Column) -> Column:
    """``(chars, lines, empty)``."""
    lines = F.when(text == "", 0).otherwise(F.regexp_count(text, F.lit("\n")) + 1)
    return F.struct(F.char_length(text).alias("chars"), lines.alias("lines"), (F.trim(text) == "").alias("empty"))


def top_flag(x: Column) -> Column:
    """A spreadsheet's flag: 1 is true, other numbers are false, other text is true unless empty."""
    number = x.try_cast("double")
    return F.coalesce(F.when(number.isNotNull(), (number >= 1) & (number < 2)).otherwise(strip_space(x) != ""), F.lit(False))


def whole_number(x: Column) -> Column:
    """Null where it is no number or too large for an integer."""
    number = x.try_cast("double")
    return F.when((number > -(1 << 31)) & (number < 1 << 31), number.try_cast("int"))


def context_text(name: Column, affiliation: Column) -> Column:
    return F.concat_ws(" | ", blank_to_null(name), blank_to_null(affiliation))


def anchor_entry(raw: Column) -> Column:
    """``(raw, kind, normalized)``; kind is doi, title or invalid (looks like a DOI but isn't one)."""
    text = strip_space(raw)
    doi = doi_checked(raw)
    looks = text.rlike(r"(?i)^(https?://(dx\.)?doi\.org/|doi:|10\.)")
    kind = F.when(doi.isNotNull(), "doi").when(looks, "invalid").otherwise("title")
    normal = F.when(doi.isNotNull(), doi).when(~looks, title_loose(raw))
    return F.struct(raw.alias("raw"), kind.alias("kind"), normal.alias("normalized"))
