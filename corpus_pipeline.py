"""From documents to training tokens: five stages, each over all its predecessor kept.

Toxic documents go; of each group of near copies one document stays; secrets are blanked out;
sources are mixed to their target weights, which repeats or leaves out documents; what is left
is encoded. Every stage is written as Parquet and read again, so a lost executor never costs
more than the running stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilmart.llm import bpe, mixing, oddsketch, secretscan, toxicity
from vigilmart.sources.workspace import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
VOCABULARY = "byte_bpe_50k.tiktoken"


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, does not call toxic."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where("predicted = 0").select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies, and all without an id."""
    found = oddsketch.near_duplicates(docs)
    return docs.join(found.where("not kept").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark; n_chars follows the text."""
    found = secretscan.scan(docs)
    blanked = found.withColumn("text", secretscan.redacted(F.col("text"), F.col("spans")))
    changed = F.when(F.size("spans") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return blanked.withColumn("n_chars", changed).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, none to twice."""
    return mixing.emitted(mixing.mix(docs, mixing.word_count(F.col("text")))).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the text they decode to."""
    return bpe.digested(bpe.coded(docs, public_tokenizers.path(VOCABULARY)))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("minhash_near_dedup", without_copies),
    ("secret_scans", without_secrets),
    ("mixing", mixed),
    ("bpe", encoded),
]

# A trained classifier and the tokenizer are beyond SQL; a test compares run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
