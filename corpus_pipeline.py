"""Curation of the documents table: five stages, each written as Parquet and read again by the next.

Defined cases are those of the operators: null text counts as empty and goes through all stages; rows of
null doc_id are documents like others; repeated rows are equal texts, of which one stays; an empty table
gives no rows; extra columns, whatever their names, are returned by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molspark.llm import decontaminate, exact_dedup, packing, quality, queries, simhash
from molspark.session import materialised


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.drop_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: fingerprints of three-word shingles, 3 bits apart or
    fewer, as the operator's contract has them. Texts without words are one group."""
    return simhash.drop_near_copies(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences, with their token ids."""
    pieces = packing.pack(docs, queries.tokenizer_path())
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality", good),
    ("exact dedup", exact),
    ("near dedup", near),
    ("decontamination", clean),
    ("packing", packed),
]

#: SQL has neither the classifier, nor SimHash, nor the tokenizer: tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = materialised(docs)
    return docs
