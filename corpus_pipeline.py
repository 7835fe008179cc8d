"""The corpus pipeline: documents in, packed training batches out, one operator of ``tallybridge.llm`` a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.llm.common import staged, table
from tallybridge.llm.decontamination import remove_contaminated
from tallybridge.llm.language_id import keep_identified, learn
from tallybridge.llm.packing import n_words, pack
from tallybridge.llm.secret_scan import redact
from tallybridge.llm.simhash_dedup import keep_one
from tallybridge.session import recorded, remove_folder


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; learned from the labelled documents of the stage's input."""
    return keep_identified(docs, learn(docs))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of each piece of each document; texts stay where they are, named by doc_id."""
    rows = docs.select("doc_id", "lang", "source", n_words(F.col("text")).alias("length"))
    return pack(rows, F.col("length")).drop("length")


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: Language identification and secret scans are trained classifiers: no SQL has their rows. Tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again before the next one.

    Once it is written, the stage's own tables and what it read from the stage before are deleted.
    """
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with recorded() as made:
            docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        *own, written = made
        for folder in [*own, *before]:
            remove_folder(spark, folder)
        before = [written]
    return docs
