"""The corpus pipeline: stages from raw documents to packed token sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plexus.llm import decontamination, packing, quality_rules, secret_scan, simhash
from plexus.llm.common import table
from plexus.session import materialize

END_ID = 2


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.keep_one(docs, shingle=4, radius=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a copy of a test item go."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Confirmed secrets are masked in the text; all documents stay."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("secret_scans", hide_secrets),
    ("packing", pack),
]

# Binomial tails, fingerprints, alignments, the forest and the token ids have no SQL
# form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs, name.replace("_", "-"))
    return docs
