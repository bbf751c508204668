"""A corpus pipeline from documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read back as the next stage's ``docs``. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import jaccard, lines, mixing, packing, toxicity
from strata.llm.common import importable, staged, table
from strata.llm.queries import MIX_WEIGHTS, mix_levels

ORACLE_SQL = None  # SQL cannot express the trained model, edit distance or packing


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go."""
    importable(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every group of equal or nearly equal lines keeps its first occurrence; documents
    left without a line go."""
    importable(spark)
    out = lines.dedup_lines(docs, counts=False, drop_emptied=True)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (shingles of five words, similarity 0.8)."""
    importable(spark)
    return jaccard.keep_one(docs, width=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target mixture takes, in one pass over 90 % of the tokens."""
    importable(spark)
    return mixing.keep_mixture(docs, mix_levels(), MIX_WEIGHTS, share_of_tokens=0.9, seed=1)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences of 2048 tokens."""
    importable(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing sources", mixed),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; every stage's result is written
    to the shared scratch folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
