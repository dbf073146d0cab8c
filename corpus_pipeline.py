"""The corpus pipeline: five stages over ``documents``. Each takes what the one before
kept, is written as Parquet in the shared folder and read again; a stage's folder goes once
the next one is written, so that only the last one's stays, which the result reads.

Defined cases, stage by stage: null and empty texts, and texts without a letter, have no known
language and go first; so do all rows of a table without labelled ones. Rows with null ids or null
sources go through like others; of repeated rows and near copies one stays, that of the smallest id (a
row without id only if none has one). Very long texts are read whole, masked, mixed and at last cut
into as many bins as they need. Ties are settled by each operator's rule. All columns of the input are
kept up to the mixing, whatever their names; the last stage returns the places of pieces. An empty
table gives an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from riskweave.llm import language, mixing, packing, pii, simhash
from riskweave.llm.common import read, remove, shared_folder

#: A text must look at least this much like some language's profile.
MIN_LANGUAGE_SCORE = 0.2


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a known language go."""
    return language.keep_identified(docs, MIN_LANGUAGE_SCORE)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each group stays."""
    return simhash.keep_one(docs)


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: what is found is masked in the text; every document stays."""
    return pii.mask(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each document as often as its source's target takes it."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: where each piece of each document lies."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identified),
    ("simhash_near_dedup", deduplicated),
    ("pii_masking", without_pii),
    ("source_mixing", mixed),
    ("best_fit_packing", packed),
]

#: Hashes, learned profiles and seeded draws: not expressible in SQL. The tests
#: compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, before)
        before = f"{folder}/{name}"
    return docs
