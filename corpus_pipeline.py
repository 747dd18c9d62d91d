"""The corpus pipeline: toxicity, near copies, repeated passages, secrets, packing.

Every stage takes and, but for the last, returns rows with the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm.common import importable_by_workers, stored, table
from postlake.llm.packing import pack
from postlake.llm.queries import WORD_TOKENIZER
from postlake.llm.secret_scan import without_secrets
from postlake.llm.simhash import without_near_duplicates
from postlake.llm.spans import without_repeated_spans
from postlake.llm.tokens import vocabulary
from postlake.llm.toxicity import train_severity, without_toxic

# Near copies: fingerprints of three-word shingles that differ in three bits at most.
COPY_WORDS, COPY_RADIUS = 3, 3

# Repeated passages: two sentences or more; only runs of two words, such as 'Yes. No.', may repeat.
PASSAGE_SENTENCES, PASSAGE_WORDS = 2, 3


def _with_text(rows: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` out of ``row``, with another text and its length."""
    field = lambda c: F.col("row").getField(c)
    changed = F.col(text)
    return rows.select(
        *[
            changed.alias(c) if c == "text"
            else F.when(changed.eqNullSafe(field("text")), field(c)).otherwise(F.length(changed)).alias(c)
            if c == "n_chars"
            else field(c).alias(c)
            for c in docs.columns
        ]
    )


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that the severity model rejects; it learns from the labels of ``docs``."""
    return without_toxic(docs, train_severity(docs, table(spark, sf_dir, "labels")))


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the lowest id."""
    importable_by_workers(spark)
    return without_near_duplicates(docs, COPY_WORDS, COPY_RADIUS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated passages; those of which nothing is left go."""
    importable_by_workers(spark)
    found = without_repeated_spans(docs, PASSAGE_SENTENCES, PASSAGE_WORDS)
    text = F.when(F.col("clean.n_removed") > 0, F.col("clean.text")).otherwise(F.col("row").getField("text"))
    left = found.withColumn("_text", text).filter("clean.n_removed = 0 OR clean.n_removed < clean.n_sentences")
    return _with_text(left, docs, "_text")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a mark in place of each secret."""
    return _with_text(without_secrets(docs), docs, "text")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    importable_by_workers(spark)
    return pack(docs, vocabulary(WORD_TOKENIZER), with_ids=False)


STAGES = [
    ("toxicity", toxicity),
    ("simhash", simhash),
    ("substrings", substrings),
    ("secrets", secrets),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
