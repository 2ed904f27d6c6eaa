"""Training-data pipeline over ``documents``: five stages, one after another.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import scratch, table
from strata.llm.decontam import remove_contamination
from strata.llm.pii import replace_pii
from strata.llm.quality_lm import keep_accepted
from strata.llm.sentencepiece_topk import sample_segmentations
from strata.llm.simhash import keep_one


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model accepts."""
    return keep_accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return _recounted(remove_contamination(docs, table(spark, sf_dir, "benchmark")))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data."""
    return _recounted(replace_pii(docs))


def segmentations(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of each document."""
    return sample_segmentations(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("pii", surrogates),
    ("sentencepiece", segmentations),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


# The language model, keyed surrogates and sampled segmentations are beyond
# SQL; tests/llm checks run() against brute-force versions of its stages.
ORACLE_SQL = None
