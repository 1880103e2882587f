"""Readers for the small text files the jobs exchange.

Malformed rows never fail a job: numbers go through ``try_cast`` (Spark runs
with ANSI mode on, where a plain cast of ``"abc"`` raises) and are dropped.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiflow.functions.render import TOKEN_SEPARATOR


def read_word_counts(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """``word<sep>n`` lines → (word, n). The empty word of the first row is kept.

    The line is cut at its last separator, so the word part may be empty.
    """
    pattern = f"^(.*){re.escape(sep)}([^{re.escape(sep)}]*)$"
    raw = spark.read.text(path)
    word = F.regexp_extract("value", pattern, 1)
    n = F.regexp_extract("value", pattern, 2)
    return (raw.where(F.col("value").rlike(pattern))
            .select(word.alias("word"), n.alias("_n"))
            .select("word", F.expr("try_cast(_n AS BIGINT)").alias("n"))
            .where(F.col("n").isNotNull()))


def read_stop_list(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Stop words from a file: one per line, optionally followed by ``<sep>count``.

    Only the word part is used, so a ``word,count`` file and a words-only file
    give the same list.
    """
    raw = spark.read.text(path)
    word = F.when(F.instr("value", sep) > 0, F.substring_index("value", sep, 1)) \
        .otherwise(F.col("value"))
    return raw.select(word.alias("word")).where(F.col("word") != "").distinct()


def read_processed(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """``id<sep>t1;t2;…`` lines → (doc_id, tokens, size)."""
    raw = spark.read.text(path)
    parts = F.split("value", sep, 2)
    doc_id = F.expr(f"try_cast(split(value, '{sep}', 2)[0] AS BIGINT)")
    # a document is a set: repeated tokens keep their first position
    tokens = F.array_distinct(F.split(F.get(parts, 1), TOKEN_SEPARATOR))
    return (raw.select(doc_id.alias("doc_id"), tokens.alias("tokens"))
            .where(F.col("doc_id").isNotNull() & F.col("tokens").isNotNull())
            .withColumn("size", F.size("tokens")))


def read_scalar(spark: SparkSession, path: str, name: str = "value") -> DataFrame:
    """A one-line number file → one-row DataFrame; the last numeric line wins."""
    raw = spark.read.text(path).select(
        F.expr("try_cast(trim(value) AS BIGINT)").alias("v"),
        F.monotonically_increasing_id().alias("_pos"))
    return raw.where(F.col("v").isNotNull()).agg(F.max_by("v", "_pos").alias(name))
