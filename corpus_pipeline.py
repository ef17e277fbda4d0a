"""From raw documents to a training mix: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoloom.llm import decontamination, mixing, queries, secrets, simhash, toxicity
from sonoloom.llm.common import shared_folder, written


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain does not call toxic; it is trained on labelled rows of its input."""
    chain = toxicity.fit_chain(docs, queries.table(spark, sf_dir, "labels"), queries.categories())
    return toxicity.without(docs, chain, "toxic")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints within 2 bits connect, by 3-word shingles."""
    return simhash.keep_first(docs, max_distance=2, width=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item to four fifths of its 5-word shingles or more."""
    return decontamination.clean(docs, queries.table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in the text replaced; `n_chars` follows the text."""
    ledger = shared_folder(spark)
    secrets.update_ledger(docs, ledger)
    clean = secrets.redacted(docs, ledger)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's rate and its draw say, numbered by `copy`."""
    return mixing.emitted(mixing.mix(docs, queries.source_weight()))


STAGES = [
    ("toxicity", toxicity_filter),
    ("simhash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontaminate),
    ("secret scans", redact_secrets),
    ("mixing sources", mix_sources),
]

#: Training a chain and connecting fingerprints are no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, one after the other."""
    docs = queries.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
