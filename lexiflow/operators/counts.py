"""Counting jobs: word counts, first-letter counts, stop-word lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.functions.text import first_letter, tokenize, tokens
from lexiflow.session import materialize

# Fixed value of the reference: a word is a stop word when it occurs more
# than this many times.
STOP_WORD_THRESHOLD = 4000
#: hash buckets of the first count of frequent words
COUNT_BUCKETS = 1 << 18


def explode_tokens(lines: DataFrame, text_col: str = "value", *, clean: bool = True,
                   lower: bool = False, keep_empty: bool = False,
                   distinct_per_row: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flat-map each row's text to one row per token, column ``word``.

    ``keep`` columns (e.g. a document name or line id) are carried along.
    """
    if not distinct_per_row:
        return tokens(lines, text_col, clean=clean, lower=lower, keep_empty=keep_empty, keep=keep)
    toks: Column = tokenize(text_col, clean=clean, lower=lower, keep_empty=keep_empty)
    return lines.select(*keep, F.explode(F.array_distinct(toks)).alias("word"))


def word_count(words: DataFrame, word_col: str = "word") -> DataFrame:
    """(word, n): occurrences per word. Partial counts are combined map-side."""
    return words.groupBy(F.col(word_col).alias("word")).agg(F.count(F.lit(1)).alias("n"))


def count_words(lines: DataFrame, text_col: str = "value", **token_opts) -> DataFrame:
    """Tokenize and count in one plan (A1, A2, A4 with ``lower=True``)."""
    return word_count(explode_tokens(lines, text_col, **token_opts))


def first_letter_count(words: DataFrame, word_col: str = "word") -> DataFrame:
    """(letter, n): tokens per lower-cased first character (A3)."""
    return (words.groupBy(first_letter(word_col).alias("letter"))
            .agg(F.count(F.lit(1)).alias("n")))


def stop_words(counts: DataFrame, threshold: int = STOP_WORD_THRESHOLD) -> DataFrame:
    """Words whose global count is strictly above ``threshold`` (F5 over exact totals)."""
    return counts.where(F.col("n") > threshold)


def frequent_words(words: DataFrame, threshold: int = STOP_WORD_THRESHOLD, word_col: str = "word",
                   buckets: int = COUNT_BUCKETS) -> DataFrame:
    """(word, n) of the words counted more than ``threshold`` times, exactly.

    For vocabularies of which few words are frequent, while occurrences per bucket stay below ``threshold``
    on average (beyond that every bucket is frequent and :func:`word_count` alone is cheaper). First, occurrences are counted per hash bucket: a task
    shuffles ``buckets`` rows at most, however many words it has seen. A word cannot be frequent if its whole
    bucket is not, so only words of the frequent buckets, of which there are at most
    ``occurrences / threshold``, are counted one by one. The table of these buckets has at most ``buckets``
    rows of one integer and is broadcast. The words are read twice.
    """
    bucket = F.pmod(F.xxhash64(F.col(word_col)), F.lit(buckets)).cast("int")
    heavy = (words.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
             .where(F.col("_n") > threshold).select("_bucket"))
    heavy = materialize(heavy, "frequent-buckets")
    left = words.join(F.broadcast(heavy), bucket == F.col("_bucket"), "left_semi")
    return stop_words(word_count(left, word_col), threshold)


def top_words(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` most frequent words, ties by word (a top-k report, O6)."""
    return counts.orderBy(F.col("n").desc(), F.col("word")).limit(k)


def job_counters(lines: DataFrame, text_col: str = "value", **token_opts) -> DataFrame:
    """One row of record counters of a word-count job (A16):
    input_records (lines read), output_records (tokens emitted), output_groups (words).

    The three numbers come from two aggregates folded by one more; no join.
    """
    toks = tokenize(text_col, **token_opts)
    per_line = lines.select(F.lit("line").alias("_m"), F.size(toks).cast("bigint").alias("_v"))
    groups = word_count(explode_tokens(lines, text_col, **token_opts)).select(
        F.lit("group").alias("_m"), F.lit(1).cast("bigint").alias("_v"))
    both = per_line.unionByName(groups)
    return both.agg(F.count(F.when(F.col("_m") == "line", 1)).alias("input_records"),
                    F.coalesce(F.sum(F.when(F.col("_m") == "line", F.col("_v"))), F.lit(0))
                    .cast("bigint").alias("output_records"),
                    F.count(F.when(F.col("_m") == "group", 1)).alias("output_groups"))

