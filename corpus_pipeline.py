"""A corpus pipeline over ``documents``: language ID, exact dedup, near-dedup,
benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame.  ``run`` writes
what a stage returns as Parquet to the shared folder and reads it back as the
next stage's ``docs``, so a lost executor costs no more than one stage.  All
stages but the last return the columns they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from deckframe.llm.op01_spaced_seeds import drop_contaminated
from deckframe.llm.op02_cuckoo_dedup import keep_documents
from deckframe.llm.op04_best_fit_pack import pack, pieces
from deckframe.llm.op09_language_fusion import keep_identified
from deckframe.llm.op10_minhash_join import keep_representatives
from deckframe.llm.staging import staged


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language go."""
    return keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    return keep_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the one with the smallest id stays."""
    return keep_representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with ``benchmark`` go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of what is left, with their places in sequences."""
    cut = pieces(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return pack(staged(cut.drop("ids"), "pieces"))


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("minhash_near_dedup", near),
    ("benchmark_decontamination", decontaminate),
    ("best_fit_packing", packing),
]

# SQL can't express tokens and signatures; tests/llm holds the stages against
# brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
