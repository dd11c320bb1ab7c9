"""Work records to tables, and the writes that keep what is there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colophon.functions.normalize import abstract_last, first_not_blank, is_international, last_segment
from colophon.operators.runstats import RunStats, without_sink
from colophon.storage import kept


def number_rows(df: DataFrame, order: list, start: int = 1, name: str = "row_id", listed: str | None = None) -> DataFrame:
    """``df`` with consecutive numbers in ``order``, without one task that sees all rows.

    Rows are split by ranges of the order; each range's count gives the next one's offset. What the
    driver gets is a count for each partition. With ``listed``, an array of structs, what is numbered and kept are its
    elements, row by row; only whole rows move.
    """
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = parts.select(F.inline(listed)) if listed else parts
    parts = parts.withColumn("_part", F.spark_partition_id())
    parts = kept(parts.withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    counts = {r["_part"]: r["n"] for r in parts.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, total = [], start
    for part in sorted(counts):
        offsets.append((part, total))
        total += counts[part]
    if not offsets:
        return parts.drop("_part", "_at").withColumn(name, F.lit(None).cast("long"))
    pairs = df.sparkSession.createDataFrame(offsets, "_part int, _offset long")
    out = parts.join(F.broadcast(pairs), "_part")
    return out.withColumn(name, F.col("_offset") + F.col("_at")).drop("_part", "_at", "_offset")


def first_of(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def first_values(df: DataFrame, key: str, columns: list[str], order: list[str]) -> DataFrame:
    """The ``columns`` of each key's first row, in ``order``; tasks send on a row for each key they have, not all rows."""
    first = df.groupBy(key).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_first"))
    return first.select(key, "_first.*")


def insert_absent(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``existing`` and the rows of ``new`` whose keys it lacks; rows with a null key always come in."""
    return existing.unionByName(new.join(existing.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


#: Rows with a null key are dealt to so many parts of a left join, in place of one.
NULL_PARTS = 1024


def left_join(rows: DataFrame, other: DataFrame, key: str | Column, other_key: str) -> DataFrame:
    """``rows`` with the columns of ``other`` whose key equals; rows without a key don't all meet in one task."""
    key = F.col(key) if isinstance(key, str) else key
    spread = F.when(key.isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(NULL_PARTS))).otherwise(-1)
    left, right = rows.withColumns({"_at": key, "_spread": spread}), other.withColumn("_other", F.lit(-1).cast("long"))
    joined = left.join(right, (F.col("_at") == F.col(other_key)) & (F.col("_spread") == F.col("_other")), "left")
    return joined.drop("_at", "_spread", "_other")


def fill_nulls(existing: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``existing`` with null ``columns`` taken from ``updates``, which has a row for each key at most."""
    renamed = updates.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in columns])
    out = left_join(existing, renamed, key, "_key")
    return out.withColumns({c: F.coalesce(c, f"_{c}") for c in columns}).select(*existing.columns)


def merge_flags(existing: DataFrame, seen: DataFrame, key: str, flags: list[str], keep_first: list[str], order: str) -> DataFrame:
    """Flags are or-ed over repeated rows and the present value; other columns keep the first value."""
    merged = seen.groupBy(F.col(key).alias("_key")).agg(
        *[F.bool_or(F.coalesce(c, F.lit(False))).alias(f"_{c}") for c in flags],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_{c}") for c in keep_first],
    )
    out = existing.join(merged, F.col(key) == F.col("_key"), "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(False)) | F.coalesce(f"_{c}", F.lit(False)) for c in flags})
    return out.withColumns({c: F.coalesce(c, f"_{c}") for c in keep_first}).select(*existing.columns)


def paper_columns() -> list[Column]:
    """The columns of ``papers``, from a work record."""
    source, topic, percentile = "primary_location.source", "primary_topic", "citation_normalized_percentile"
    named = (
        last_segment(F.col("id")).alias("id"),
        "doi",
        F.when(F.coalesce("title", F.lit("")) == "", "Untitled").otherwise(F.col("title")).alias("title"),
        "publication_year",
        "publication_date",
        "type",
        F.col(f"{source}.display_name").alias("journal_name"),
        F.col(f"{source}.issn_l").alias("journal_issn"),
        F.col(f"{source}.is_core").alias("is_core_journal"),
        F.col(f"{source}.host_organization_name").alias("publisher"),
        F.col("open_access.is_oa").alias("is_oa"),
        F.col("open_access.oa_status").alias("oa_status"),
        F.col("open_access.oa_url").alias("oa_url"),
        "cited_by_count",
        F.col(f"{percentile}.value").alias("citation_percentile"),
        F.col(f"{percentile}.is_in_top_1_percent").alias("is_top_1_percent"),
        F.col(f"{percentile}.is_in_top_10_percent").alias("is_top_10_percent"),
        "fwci",
        last_segment(F.col(f"{topic}.id")).alias("primary_topic_id"),
        F.col(f"{topic}.display_name").alias("primary_topic_name"),
        F.col(f"{topic}.score").alias("primary_topic_score"),
        F.col(f"{topic}.field.display_name").alias("primary_topic_field"),
        F.col(f"{topic}.subfield.display_name").alias("primary_topic_subfield"),
        F.col(f"{topic}.domain.display_name").alias("primary_topic_domain"),
        "institutions_distinct_count",
        "countries_distinct_count",
        is_international(F.col("countries_distinct_count")).alias("is_international"),
        abstract_last(F.col("abstract_inverted_index")).alias("abstract_text"),
        "updated_date",
    )
    return [F.col(c) if isinstance(c, str) else c for c in named]


#: What a table needs of a row of ``affiliations``, besides its place.
NEEDED = {
    "authors": ("author_id", "_author", "_orcid"),
    "institutions": ("institution_id", "_institution", "country_code", "_type", "_ror"),
    "countries": ("country_code",),
    "contributions": (
        "author_id", "institution_id", "country_code", "author_name", "author_position", "is_corresponding", "raw_affiliation_string",
    ),
}


def affiliations(authorships: Column, needed: set[str]) -> Column:
    """An array of a struct for each institution with an id of each authorship, or one for an authorship without any listed."""

    def row(a: Column, author_no: Column, inst: Column | None, inst_no: Column) -> Column:
        null, raw = F.lit(None).cast("string"), a["raw_affiliation_strings"]
        columns = {
            "author_id": last_segment(a["author"]["id"]),
            "institution_id": null if inst is None else last_segment(inst["id"]),
            "country_code": F.get(a["countries"], F.lit(0)) if inst is None else inst["country_code"],
            "author_name": F.coalesce(a["raw_author_name"], a["author"]["display_name"]),
            "author_position": a["author_position"],
            "is_corresponding": a["is_corresponding"],
            "raw_affiliation_string": first_not_blank(raw) if inst is None else F.get(raw, inst_no),
            "_author": a["author"]["display_name"],
            "_orcid": a["author"]["orcid"],
            "_institution": null if inst is None else inst["display_name"],
            "_type": null if inst is None else inst["type"],
            "_ror": null if inst is None else inst["ror"],
        }
        return F.struct(author_no.alias("author_no"), inst_no.alias("inst_no"), *(c.alias(n) for n, c in columns.items() if n in needed))

    def rows(a: Column, author_no: Column) -> Column:
        found = F.transform(a["institutions"], lambda inst, k: F.when(inst["id"].isNotNull(), row(a, author_no, inst, k)))
        return F.when(F.size(a["institutions"]) > 0, F.filter(found, lambda r: r.isNotNull())).otherwise(F.array(row(a, author_no, None, F.lit(0))))

    return F.flatten(F.transform(authorships, rows))


CONTRIBUTION = ("paper_id", *NEEDED["contributions"])
TABLES = ("papers", "authors", "institutions", "countries", "contributions")


def load(
    works: DataFrame,
    present: dict[str, DataFrame] | None = None,
    stats: RunStats | None = None,
    only: tuple[str, ...] = TABLES,
    numbered: bool = True,
) -> dict[str, DataFrame]:
    """The five tables from work records with ``_file`` and ``_line``, added to those ``present``, or those named by ``only``.

    ``stats`` get the records read (and bad ones, without id or not to be parsed), the papers taken in and
    their contributions; records that are neither bad nor taken in are repeated or known.

    ``numbered`` false leaves out the numbers of new contributions and countries, which cost a sort of all rows.

    A paper that is there already is skipped with all its contributions; of repeated works the
    first in order of file and line counts; so it is for authors and institutions.
    """
    if present and not numbered:
        raise ValueError("rows that are added to tables need numbers")
    order = ["_file", "_line"]
    good = F.col("id").isNotNull() & F.col("_corrupt_record").isNull()
    if stats:
        works = stats.watch("records", works, bad=F.count_if(~good))
    new = works.filter(good)
    # records are parsed once, to what the tables need; only that moves
    listed, needed = set(only) - {"papers"}, {c for name in only for c in NEEDED.get(name, ())}
    columns = [last_segment(F.col("id")).alias("_key"), *order]
    columns += [F.struct(*paper_columns()).alias("_paper")] if "papers" in only else []
    columns += [affiliations(F.col("authorships"), needed).alias("_rows")] if listed or stats else []
    new = new.select(*columns)
    if present:
        known = present["papers"].select(F.col("id").alias("_key"))
        new = new.join(known, "_key", "left_anti")
    new = first_of(new, ["_key"], order)
    new = stats.watch("papers", new) if stats else new
    if "papers" in only or stats and listed:
        new = kept(new)
    made = {"papers": new.select("_paper.*")} if "papers" in only else {}
    if not stats and not listed:
        return joined_tables(made, present)
    rows = new.select(F.col("_key").alias("paper_id"), *order, F.inline("_rows"))
    rows = stats.watch("contributions", rows) if stats else rows
    if stats and not listed:
        without_sink(rows)
    elif stats or listed - ({"contributions"} if numbered else set()):
        rows = kept(rows)
    place = [*order, "author_no", "inst_no"]
    if "authors" in only:
        authors = first_values(rows.filter("author_id is not null"), "author_id", ["_author", "_orcid"], place)
        made["authors"] = authors.select(F.col("author_id").alias("id"), F.col("_author").alias("display_name"), F.col("_orcid").alias("orcid"))
    if "institutions" in only:
        known = first_values(rows.filter("institution_id is not null"), "institution_id", ["_institution", "country_code", "_type", "_ror"], place)
        made["institutions"] = known.select(
            F.col("institution_id").alias("id"),
            F.col("_institution").alias("display_name"),
            "country_code",
            F.col("_type").alias("type"),
            F.col("_ror").alias("ror_id"),
            F.lit(False).alias("is_synthetic"),
        )
    if "countries" in only:
        codes, first_id = rows.filter("country_code is not null").select("country_code").distinct(), 1
        if present:
            first_id += present["countries"].agg(F.max("id")).first()[0] or 0
            codes = codes.join(present["countries"].select("country_code"), "country_code", "left_anti")
        codes = number_rows(codes, ["country_code"], first_id, "id").withColumn("id", F.col("id").cast("int")) if numbered else codes
        made["countries"] = codes.select(
            *(["id"] if numbered else []),
            F.concat(F.lit("["), "country_code", F.lit("]")).alias("country_name"),
            "country_code",
            F.lit(1).alias("status"),
        )
    if "contributions" in only:
        start = 1 + ((present["contributions"].agg(F.max("row_id")).first()[0] or 0) if present else 0)
        if numbered:
            # a paper's rows are numbered where the paper is
            lines = F.transform("_rows", lambda r: F.struct(F.col("_key").alias("paper_id"), *(r[c].alias(c) for c in NEEDED["contributions"])))
            lines = new.select(*order, lines.alias("_lines"))
            made["contributions"] = number_rows(lines, order, start, listed="_lines").select("row_id", *CONTRIBUTION)
        else:
            made["contributions"] = rows.select(*CONTRIBUTION)
    return joined_tables(made, present)


def joined_tables(made: dict[str, DataFrame], present: dict[str, DataFrame] | None) -> dict[str, DataFrame]:
    """The tables made, after those that are there."""
    if not present:
        return made
    keys = {"authors": ["id"], "institutions": ["id"]}
    return {
        name: insert_absent(present[name], df, keys[name])
        if name in keys
        else present[name].unionByName(df, allowMissingColumns=True)
        for name, df in made.items()
    }
