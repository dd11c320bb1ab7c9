"""Missing institutions and countries filled by rules and predictions, with an audit trail."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.functions.country import infer_country
from colophon.functions.normalize import blank_to_null, context_text, country_code, not_blank, strip_space, synthetic_institution_id
from colophon.operators.ingest import fill_nulls, first_of, insert_absent
from colophon.operators.matching import nearest_vectors
from colophon.operators.runstats import RunStats, watched

STAGES = (1, 2, 3)


def stages(text: str) -> list[int]:
    """Stage numbers out of ``1,2,3``."""
    chosen = sorted({int(p) for p in text.split(",") if p.strip()})
    if not chosen or not set(chosen) <= set(STAGES):
        raise ValueError(f"stages are 1, 2 and 3, not {text!r}")
    return chosen


def missing_institution(contributions: DataFrame, limit: int | None = None) -> DataFrame:
    rows = contributions.filter(F.col("institution_id").isNull() & not_blank(F.col("raw_affiliation_string")))
    return rows.orderBy("row_id").limit(limit) if limit else rows


def missing_country(contributions: DataFrame, limit: int | None = None) -> DataFrame:
    rows = contributions.filter(F.col("country_code").isNull() & not_blank(F.col("raw_affiliation_string")))
    return rows.orderBy("row_id").limit(limit) if limit else rows


def institutions_missing_country(institutions: DataFrame, contributions: DataFrame) -> DataFrame:
    """``(id, display_name, sample_affiliation)``; the sample is the least affiliation text."""
    lacking = institutions.filter(~not_blank(F.col("country_code"))).select("id", "display_name")
    samples = contributions.filter(not_blank(F.col("raw_affiliation_string"))).groupBy("institution_id")
    samples = samples.agg(F.min("raw_affiliation_string").alias("sample_affiliation"))
    return lacking.join(samples, lacking["id"] == samples["institution_id"], "left").drop("institution_id")


def papers_lacking(papers: DataFrame, contributions: DataFrame, raw_too: bool = False, title_ok: bool = False) -> DataFrame:
    """Papers with a DOI (or, if ``title_ok``, a title) and a row without institution (and affiliation)."""
    gap = F.col("institution_id").isNull()
    if raw_too:
        gap = gap & ~not_blank(F.col("raw_affiliation_string"))
    known = not_blank(F.col("doi"))
    if title_ok:
        known = known | F.coalesce(F.col("title") != "Untitled", F.lit(False))
    rows = contributions.filter(gap).select(F.col("paper_id").alias("id"))
    return papers.filter(known).join(rows, "id", "left_semi")


def clean_predictions(found: DataFrame, key: str = "row_id", least: float = 0.8) -> DataFrame:
    """One prediction for each key: the first by ``ordinal`` or as they come; without key, or under the confidence, they go."""
    out = found.withColumns(
        {
            "country_code": country_code(F.col("country_code")),
            "confidence": F.coalesce(F.col("confidence").cast("double"), F.lit(0.0)),
        }
    )
    if "institution_name" in found.columns:
        out = out.withColumn("institution_name", blank_to_null(strip_space(F.col("institution_name"))))
    if "ordinal" not in found.columns:
        out = out.withColumn("_place", F.monotonically_increasing_id())
    sure = out.filter(F.col(key).isNotNull() & (F.col("confidence") >= least))
    return first_of(sure, [key], ["ordinal" if "ordinal" in found.columns else "_place"]).drop("_place")


def predict(rows: DataFrame, predictor: Callable, schema: str, batch_rows: int = 20) -> DataFrame:
    """What ``predictor(list of dicts) -> list of dicts`` says of the rows, in batches on the executors.

    Rows left out of an answer are asked for once more.
    """
    names = [part.split()[0] for part in schema.split(", ")]

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        for frame in frames:
            asked = frame.to_dict("records")
            for k in range(0, len(asked), batch_rows):
                part = asked[k : k + batch_rows]
                said = list(predictor(part))
                have = {str(s.get("row_id")) for s in said}
                rest = [r for r in part if str(r.get("row_id")) not in have]
                said += list(predictor(rest)) if rest else []
                yield pd.DataFrame([{n: s.get(n) for n in names} for s in said], columns=names)

    return rows.mapInPandas(run, schema)


def audit(found: DataFrame, stage: str, source: str) -> DataFrame:
    """Rows for the audit table from ``row_id, paper_id, country_code, matched_terms, raw..., confidence``."""

    def have(name: str, default):
        return F.col(name) if name in found.columns else default

    null = F.lit(None).cast("string")
    return found.select(
        F.current_timestamp().alias("run_at"),
        "row_id",
        have("paper_id", null).alias("paper_id"),
        country_code(F.col("country_code")).alias("inferred_country_code"),
        have("matched_terms", null).cast("string").alias("matched_terms"),
        have("raw_affiliation_string", null).alias("raw_affiliation_string"),
        F.lit(source).alias("source"),
        F.coalesce(have("confidence", F.lit(0.0)).cast("double"), F.lit(0.0)).alias("confidence"),
        F.lit(stage).alias("stage"),
    )


def rule_countries(rows: DataFrame, text: str = "raw_affiliation_string") -> DataFrame:
    """``rows`` with the inferred ``status``, ``country_code`` and ``matched_terms``."""
    out = rows.withColumn("_found", infer_country(F.col(text)))
    return out.withColumns(
        {
            "status": F.col("_found.status"),
            "country_code": F.col("_found.country_code"),
            "matched_terms": F.array_join("_found.matched_terms", ", "),
            "confidence": F.when(F.col("_found.status") == "unambiguous", 1.0).otherwise(0.0),
        }
    ).drop("_found")


def stage_1(contributions: DataFrame, institutions: DataFrame, predicted: DataFrame, names: DataFrame | None = None, threshold: float = 0.78, least: float = 0.8, stats: RunStats | None = None):
    """Institutions and countries from predictions: ``(contributions, institutions, audit)``.

    ``stats`` get how many of the surest predictions matched, made an institution, gave a country alone or nothing. ``names``, (id, vector) of institutions and (row_id, vector) of predictions under ``kind``, lets
    a predicted name be matched to a known institution; else a synthetic one stands for it. A
    prediction of neither name nor country changes nothing and isn't in the audit.
    """
    rows = missing_institution(contributions).select("row_id", "paper_id", "raw_affiliation_string")
    found, made = resolved(rows.join(clean_predictions(predicted, least=least), "row_id"), institutions, names, threshold)
    kinds = {n: F.count_if(F.col("matched_terms").startswith(t)) for n, t in (("matched", "matched:"), ("synthetic", "synthetic:"), ("country_only", "country-only"))}
    found = watched(stats, "stage 1", found, **kinds, skipped=F.count_if(F.col("matched_terms").isNull()))
    found = found.filter("institution_id is not null or country_code is not null")
    out = fill_nulls(contributions, found, "row_id", ["institution_id", "country_code"])
    return out, insert_absent(institutions, made, ["id"]), audit(found, "1", "llm")


def resolved(found: DataFrame, institutions: DataFrame, names: DataFrame | None = None, threshold: float = 0.78) -> tuple[DataFrame, DataFrame]:
    """``found`` (row_id, institution_name, country_code) with ``institution_id``, and the institutions to be made.

    A matched institution's country goes before the predicted one. ``matched_terms`` says what was
    done: ``matched: NAME (score=0.85)``, ``synthetic: NAME`` or that only a country was found.
    """
    if names is not None:
        asked = names.filter("kind = 'prediction'").select(F.col("id").cast("long").alias("id"), "vector")
        known = names.filter("kind = 'institution'").select("id", "vector")
        near = nearest_vectors(asked, known, 1, threshold).withColumnsRenamed({"query_id": "_asked", "base_id": "_known", "score": "_score"})
        have = institutions.select(F.col("id").alias("_id"), F.col("display_name").alias("_name"), country_code(F.col("country_code")).alias("_country"))
        near = near.join(have, near["_known"] == have["_id"], "left").drop("_id")
        found = found.join(near, (found["row_id"] == near["_asked"]) & F.col("institution_name").isNotNull(), "left").drop("_asked")
    else:
        null = F.lit(None).cast("string")
        found = found.withColumns({"_known": null, "_name": null, "_country": null, "_score": F.lit(None).cast("double")})
    term = (
        F.when(F.col("_known").isNotNull(), F.format_string("matched: %s (score=%.2f)", F.coalesce("_name", "_known"), "_score"))
        .when(F.col("institution_name").isNotNull(), F.concat(F.lit("synthetic: "), "institution_name"))
        .when(F.col("country_code").isNotNull(), "country-only (no institution extracted)")
    )
    own = synthetic_institution_id(F.col("institution_name"))
    found = found.withColumn("matched_terms", term).withColumns({"matched_id": F.col("_known"), "institution_id": F.coalesce("_known", own)})
    made = found.filter("matched_id is null and institution_name is not null").groupBy("institution_id").agg(
        F.min("institution_name").alias("display_name"), F.min("country_code").alias("country_code")
    )
    found = found.withColumn("country_code", F.coalesce("_country", "country_code")).drop("_known", "_name", "_country", "_score")
    return found, made.select(F.col("institution_id").alias("id"), "display_name", "country_code", F.lit(True).alias("is_synthetic"))


def cascade_countries(contributions: DataFrame, institutions: DataFrame, found: DataFrame):
    """Countries of institutions (``id, country_code``), carried on to rows that lack one."""
    new = fill_nulls(institutions, found, "id", ["country_code"])
    codes = found.select(F.col("id").alias("institution_id"), "country_code")
    return fill_nulls(contributions, codes, "institution_id", ["country_code"]), new


def inferred(predicted: DataFrame) -> DataFrame:
    """Predictions of countries with the terms that the audit shows for them; those without a country go."""
    status = F.col("status") if "status" in predicted.columns else F.lit(None)
    said = F.concat(F.lit("llm-inferred (status="), F.coalesce(status.cast("string"), F.lit("none")), F.lit(")"))
    return predicted.filter(F.col("country_code").isNotNull()).withColumn("matched_terms", said)


def by_source() -> dict[str, Column]:
    return {s: F.count_if(F.col("source") == s) for s in ("rule", "llm")}


def stage_2(contributions: DataFrame, institutions: DataFrame, predicted: DataFrame | None = None, least: float = 0.8, stats: RunStats | None = None):
    """Countries of institutions by rule, then by prediction: ``(contributions, institutions, audit)``.

    The audit has a row for each institution that got a country, with its sample affiliation, no
    contribution and no paper.
    """
    rows = institutions_missing_country(institutions, contributions).withColumnRenamed("sample_affiliation", "raw_affiliation_string")
    ruled = rule_countries(rows.withColumn("text", context_text(F.col("display_name"), F.col("raw_affiliation_string"))), "text")
    columns = ["id", "country_code", "raw_affiliation_string", "matched_terms", "confidence"]
    found = ruled.filter("status = 'unambiguous'").select(*columns, F.lit("rule").alias("source"))
    if predicted is not None:
        rest = inferred(clean_predictions(predicted, "id", least)).join(found.select("id"), "id", "left_anti")
        rest = rest.join(rows.select("id", "raw_affiliation_string"), "id")
        found = found.unionByName(rest.select(*columns, F.lit("llm").alias("source")))
    found = watched(stats, "stage 2", found, **by_source())
    logged = found.withColumn("row_id", F.lit(None).cast(contributions.schema["row_id"].dataType))
    logs = [audit(logged.filter(F.col("source") == s), "2", s) for s in ("rule", "llm")]
    return *cascade_countries(contributions, institutions, found), logs[0].unionByName(logs[1])


def stage_3(contributions: DataFrame, predicted: DataFrame | None = None, least: float = 0.8, stats: RunStats | None = None):
    """Countries of rows by rule, then by prediction: ``(contributions, audit)``."""
    rows = missing_country(contributions).select("row_id", "paper_id", "raw_affiliation_string")
    ruled = rule_countries(rows)
    found = ruled.filter("status = 'unambiguous'")
    log = audit(found, "3", "rule")
    updates = found.select("row_id", "country_code")
    if predicted is not None:
        rest = inferred(clean_predictions(predicted, least=least)).join(updates.select("row_id"), "row_id", "left_anti").join(rows, "row_id")
        log = log.unionByName(audit(rest, "3", "llm"))
        updates = updates.unionByName(rest.select("row_id", "country_code"))
    return fill_nulls(contributions, updates, "row_id", ["country_code"]), watched(stats, "stage 3", log, **by_source())


def hong_kong_as_china(df: DataFrame, column: str = "country_code") -> DataFrame:
    code = F.upper(F.trim(column))
    return df.withColumn(column, F.when(code == "HK", "CN").otherwise(F.col(column)))


def hong_kong_repair(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables with China for Hong Kong: in contributions and institutions, and as the country's own row."""
    out = tables | {n: hong_kong_as_china(tables[n]) for n in ("contributions", "institutions")}
    countries = tables["countries"]
    code = F.upper(F.trim("country_code"))
    kept = countries.filter(F.coalesce(code != "HK", F.lit(True)))
    marked = countries.agg(F.max("id").alias("top"), F.count_if(code == "CN").alias("n"))
    new = marked.filter("n = 0").select(
        (F.coalesce("top", F.lit(0)) + 1).cast("int").alias("id"), F.lit("[CN]").alias("country_name"), F.lit("CN").alias("country_code"), F.lit(1).alias("status")
    )
    return out | {"countries": kept.unionByName(new, allowMissingColumns=True)}


def outcomes(found: DataFrame, column: str = "status") -> DataFrame:
    """Counts by outcome."""
    return found.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
