"""From documents to a training mix, in stages; each stage's rows are written and read again by the next.

Every stage but the last returns the columns of documents; the last returns, for each document that is
left, how often the mix takes it. Empty tables give empty ones; other columns, whatever their names, go
along. Texts are judged whole, however long. Rows that repeat an id, or have none, are judged row by row
by all stages but suffix_dedup, which searches one text for each id and none without; as minhash_dedup
leaves one row of each group, equal rows do not come so far. Ties go as the operators of the stages say.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from facetlake.llm import decontaminate, minhash, mixing, quality, suffix
from facetlake.llm.shared import dropped, kept


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the labels' neighbours vote for; labels of the held-out fold are not learnt from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, labels.filter(quality.fold("doc_id", 5) != 0))


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: shingles of five words, similarity of 0.8 or more."""
    return minhash.deduplicated(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the strings of 100 bytes that start earlier too; n_chars follows the text."""
    return suffix.cut_texts(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of which less than one word in twenty lies in a passage of the benchmark."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of each document in the mix."""
    return mixing.mixture(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_dedup", minhash_dedup),
    ("suffix_dedup", suffix_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

#: SQL cannot express the classifier; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of sf_dir; each stage's table, and what it wrote on the way, goes when the next one stands."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = kept(spark, partial(stage, spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            dropped(before)
        before = docs
    return docs
