"""Corpus preparation: documents to packed training sequences, in five stages.

Defined results: a null or empty text has no words and goes in the first stage; of repeated rows
and of near copies one stays; a document without an id goes through all stages with a null id, and
counts as smaller than all others where passages are compared; a document whose passages all go
stays, with an empty text; very long texts are treated whole; columns beside those of documents are
left behind; an empty table gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.llm import cascade, minhash, packing, pii, suffix
from colophon.llm.queries import vocabulary

#: Tokenizer of the packing stage.
TOKENIZER = "word_bpe_49k.json"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars`` of the text as it now is, in the columns of documents."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return cascade.quality_filter(docs).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near-duplicates (five-word shingles, 0.8); one without an id if none has one."""
    return minhash.deduplicate(docs).select(*COLUMNS)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the passages of 50 bytes or more that a smaller id has."""
    found = suffix.repeated_passages(docs, 50, ("kept_text",), carry=("lang", "source"))
    return _documents(found.withColumnRenamed("kept_text", "text"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with personal data replaced."""
    return _documents(pii.pseudonymize(docs, pii.session_key(spark), counts=False))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack(docs, vocabulary(TOKENIZER))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("suffix-array dedup", passage_dedup),
    ("PII", pseudonyms),
    ("packing", packed),
]

#: Links between documents and repeated bytes can't be put as SQL that ends; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
