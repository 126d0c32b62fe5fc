"""Documents to training tokens: quality, exact and near copies, mixing, tokens.

Each stage is written as Parquet to the shared folder and read again as the
next one's input, so a lost executor costs a task and not the run. All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifa.llm import bpe, exact_dedup, mixing, quality, queries, simhash
from tarifa.session import shipped, table, written


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return quality.kept_rows(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact copies."""
    shipped(spark)
    return exact_dedup.kept_rows(docs)


def apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    shipped(spark)
    return simhash.kept_rows(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    shipped(spark)
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document in the mix, and the digest of what they decode to."""
    shipped(spark)
    both = bpe.encoded_and_decoded(docs, queries.tokenizer_path())
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", good),
    ("exact dedup", distinct),
    ("SimHash near-dedup", apart),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", tokens),
]

#: The stages are a trained network, seeded hashes and XXH64 fingerprints, which SQL doesn't have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
