"""Corpus pipeline: raw documents to packed training rows, in five stages.

Each stage takes all documents its predecessor kept, written as Parquet and read again, and
applies one operator of ``lexiflow.llm`` with its production parameters.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lexiflow.llm import cotrain_quality, decontaminate, packing, poisson_mix, simhash_dedup
from lexiflow.llm.common import DOC_COLUMNS, table
from lexiflow.session import materialize

RANK_FILE = "byte_bpe_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    return cotrain_quality.keep_good(docs.select(DOC_COLUMNS), table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the smallest id."""
    return simhash_dedup.keep_one_per_group(docs.select(DOC_COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.remove_contaminated(docs.select(DOC_COLUMNS), table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards the target weights of their sources, globally shuffled."""
    return poisson_mix.mix(docs.select(DOC_COLUMNS)).select(DOC_COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token-id rows."""
    return packing.pack(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("mixing", mixing), ("packed", packed)]

#: the classifier, fingerprints and tokens have no SQL form; tests/llm checks the stages instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; between stages a Parquet table is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
