"""Parquet table scans of the test corpora, with column pruning at the scan."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from lexiflow.sources.lines import lines_from_documents


# Only a scan of at most this many splits (8 GB at 128 MB each) is ever spread.
BALANCE_SPLITS = 64


def balance_partitions(df: DataFrame) -> DataFrame:
    """Spread a scan that has fewer splits than the cluster has cores.

    A small table stored as one parquet row group is read by a single task,
    which then tokenizes everything alone. Such an input, of at most BALANCE_SPLITS
    splits, is spread round-robin; larger ones are left untouched on a cluster of any size, so
    no extra shuffle grows with the data.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < min(cores, BALANCE_SPLITS):
        return df.repartition(cores)
    return df


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str,
               balance: bool = True) -> DataFrame:
    """``<sf_dir>/<name>.parquet``; listing ``columns`` keeps the ReadSchema narrow."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    df = df.select(*columns) if columns else df
    return balance_partitions(df) if balance else df


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, text) of the ``documents`` table."""
    return read_table(spark, sf_dir, "documents", "doc_id", "source", "text")


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line of every document: line_id, doc_id, line_no, source, value."""
    return lines_from_documents(document_texts(spark, sf_dir), keep=("source",))


def tagged_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, value): document text tagged with its ``source`` as the file name (S3)."""
    return document_texts(spark, sf_dir).selectExpr("source AS doc", "text AS value")


def multi_corpus_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, value) over three corpora (U4): ``documents`` tagged by source,
    ``benchmark`` as one document named "benchmark", ``conversations`` tagged by role."""
    docs = read_table(spark, sf_dir, "documents", "source", "text", balance=False) \
        .selectExpr("source AS doc", "text AS value")
    bench = read_table(spark, sf_dir, "benchmark", "text", balance=False) \
        .selectExpr("'benchmark' AS doc", "text AS value")
    convs = read_table(spark, sf_dir, "conversations", "role", "text", balance=False) \
        .selectExpr("role AS doc", "text AS value")
    return balance_partitions(docs.unionByName(bench).unionByName(convs))

