"""Corpus preparation: five stages over ``documents``, each calling one operator.

Toxic documents go, one document of each near-duplicate group stays, personal
data is masked, sources are mixed to their target weights and what is left is
packed into sequences.  A stage works on all rows that the stage before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardpulse.llm import mixing, packing, pii, simhash, toxicity
from cardpulse.llm.common import staged, table
from cardpulse.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the class-conditional language models score as toxic go; all labelled ``docs`` outside the held-out fold train them, a bounded sample of these as calibration."""
    ensure_checkpoint_dir(spark)
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one with the smallest doc_id, null ids last.

    The decision is by row: rows that share a doc_id or have none are told
    apart by a hash of their text, and equal rows are copies of each other.
    """
    ensure_checkpoint_dir(spark)
    return simhash.without_near_duplicates(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data in a text becomes its kind in brackets."""
    ensure_checkpoint_dir(spark)
    return pii.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    ensure_checkpoint_dir(spark)
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes: its sequence and place there."""
    ensure_checkpoint_dir(spark)
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", near_dedup),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Trained scores, fingerprints, parsers, random order and packing are not SQL;
#: the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read back for the next."""
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
