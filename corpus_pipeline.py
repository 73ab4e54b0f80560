"""From raw documents to packed training sequences: five operators in a row.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next one's ``docs``. All stages but the last return the columns of documents. Labels come from ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harmlens.llm import compression_quality, near_duplicates, packing, secret_ledger, target_ratio
from harmlens.llm.queries import table
from harmlens.workspace import scratch_path


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return compression_quality.accepted(docs, compression_quality.fit(docs, table(spark, sf_dir, "labels")))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return target_ratio.kept(docs, target_ratio.fit(docs, table(spark, sf_dir, "labels")))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return near_duplicates.deduplicated(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced and ``n_chars`` counted anew where that changed the text."""
    found = secret_ledger.findings(secret_ledger.ledger_rows(secret_ledger.scan(docs)))
    clean = secret_ledger.joined(docs, found).withColumn("text", secret_ledger.redacted("text", "__spans"))
    changed = F.size("__spans") > 0
    return clean.withColumn("n_chars", F.when(changed, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))).drop("__spans")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    return packing.packed(docs)


STAGES = [
    ("quality classifier", classify),
    ("quality rules", apply_rules),
    ("near duplicates", deduplicate),
    ("secrets", redact),
    ("packing", pack),
]

#: The trained classifier and the tokenizer can't be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
