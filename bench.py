"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the threads. Each query runs once to warm up and
once timed; every row is computed. ``load_works`` shreds nested work records, made from orders and
their lines, into the five tables.
"""

from __future__ import annotations

import json
import os
import shutil
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from colophon import queries
from colophon.operators.coverage import health_report
from colophon.operators.ingest import load
from colophon.sources.readers import works

HEADLINE = ("coverage_buckets", "coverage_zero", "imputable_rows", "tfidf_keywords_all", "doi_overlap", "vector_nn", "author_align")


def write_works(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Orders as works with the fields and the size of real ones, their lines as authorships.

    Abstracts are the first 200 words of documents, as an index from words to places.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    part, supplier = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    institution = F.struct(
        F.concat(F.lit("https://x/I"), supplier).alias("id"),
        F.concat(F.lit("University of Supplier "), supplier).alias("display_name"),
        F.element_at(F.array(*map(F.lit, ("DE", "US", "CN", "FR"))), (F.col("l_suppkey") % 4 + 1).cast("int")).alias("country_code"),
        F.concat(F.lit("https://ror.org/"), F.md5(supplier)).alias("ror"),
        F.lit("education").alias("type"),
    )
    author = F.struct(
        F.struct(F.concat(F.lit("https://x/A"), part).alias("id"), F.concat(F.lit("Author Number "), part).alias("display_name"), F.concat(F.lit("https://orcid.org/"), part).alias("orcid")).alias("author"),
        F.when(F.col("l_returnflag") == "R", F.array()).otherwise(F.array(institution)).alias("institutions"),
        F.concat(F.lit("Author N. "), part).alias("raw_author_name"),
        F.lit("middle").alias("author_position"),
        F.array(F.concat(F.lit("Department of Physics and Astronomy, University of Supplier "), supplier, F.lit(", 1 Main Street, 12345 Town, Germany"))).alias("raw_affiliation_strings"),
    )
    authored = lines.groupBy("l_orderkey").agg(F.collect_list(author).alias("authorships"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("text is not null")
    words = F.slice(F.filter(F.split("text", r"\s+"), lambda w: w != ""), 1, 200)
    placed = docs.select("doc_id", F.posexplode(words).alias("at", "w")).groupBy("doc_id", "w").agg(F.collect_list("at").alias("ats"))
    indexes = placed.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "ats"))).alias("abstract_inverted_index"))
    count = docs.count()
    topic = F.struct(
        F.concat(F.lit("https://x/T"), (F.col("o_custkey") % 500 + 10000).cast("string")).alias("id"),
        F.concat(F.lit("Topic "), (F.col("o_custkey") % 500).cast("string")).alias("display_name"),
        F.lit(0.9).alias("score"),
        *[F.struct(F.lit(f"A {n} of science").alias("display_name")).alias(n) for n in ("subfield", "field", "domain")],
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").join(authored, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    orders = orders.join(indexes, F.col("o_orderkey") % count == F.col("doc_id"), "left")
    orders.select(
        F.concat(F.lit("https://x/W"), "o_orderkey").alias("id"),
        F.concat(F.lit("https://doi.org/10.1/"), "o_orderkey").alias("doi"),
        F.concat(F.lit("A title of the usual length for the order of number "), "o_orderkey").alias("title"),
        F.year("o_orderdate").alias("publication_year"),
        F.lit("article").alias("type"),
        F.col("o_custkey").cast("int").alias("cited_by_count"),
        topic.alias("primary_topic"),
        F.array(topic, topic, topic).alias("topics"),
        "abstract_inverted_index",
        "authorships",
    ).write.json(path)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    place = tempfile.mkdtemp(prefix="colophon-bench-")
    write_works(spark, sf_dir, f"{place}/works")

    def load_works():
        for k, df in enumerate(load(works(spark, f"{place}/works")).values()):
            df.write.mode("overwrite").parquet(f"{place}/{k}")

    def health():
        names = ("papers", "authors", "institutions", "countries", "contributions")
        health_report({n: spark.read.parquet(f"{place}/{k}") for k, n in enumerate(names)}).collect()

    def registered(name: str):
        return lambda: queries.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    jobs = {"load_works": load_works, "health_report": health} | {n: registered(n) for n in HEADLINE}
    seconds = {}
    for name, job in jobs.items():
        job()
        began = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - began, 3)
    papers = spark.read.parquet(f"{place}/0").count()
    megabytes = sum(os.path.getsize(f"{place}/works/{f}") for f in os.listdir(f"{place}/works")) / 1e6
    shutil.rmtree(place, ignore_errors=True)
    total = round(sum(seconds.values()), 3)
    rate = round(papers / seconds["load_works"])
    print(json.dumps({"metric": "headline queries, total", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir, "load_papers_per_s": rate, "load_mb_per_s": round(megabytes / seconds["load_works"], 1), "load_bytes_per_paper": round(1e6 * megabytes / papers)}))
    spark.stop()


if __name__ == "__main__":
    main()
