"""Inverted indexes over (word, doc) rows.

The index jobs start from ``(word, doc)`` rows and aggregate twice, both times with
map-side partial aggregation: first per (word, doc) — a hot word in a hot
document collapses to one row per task before any shuffle — then per word. Whether a word
is in one document only needs a single aggregate (:func:`word_spread`).

Stop words can be removed two ways:
* ``stop``: an external stop list, matched without regard to case and removed with a
  left-anti join (the side is broadcast only after its rows and bytes are checked);
* ``max_count``: when the stop list is "words counted more than T times in
  this same corpus", the (word, doc, tf) table is written once, the words whose
  total exceeds T are listed from it, and an anti-join removes their rows *before*
  posting lists are collected, so no list holds more than T documents.

With neither given every word is indexed, however often it occurs; for lists without
such a bound :func:`posting_blocks` cuts a list into rows of bounded length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiflow.functions.render import join_docs, join_tf_postings
from lexiflow.operators.joins import (DEFAULT_BROADCAST_ROWS, DEFAULT_KEY_BROADCAST_BYTES,
                                      broadcast_if_small, key_table_bytes)
from lexiflow.operators.ranks import dense_ranks
from lexiflow.session import materialize, materialize_measured

#: bits of the bitmap that stands for a stop list too large to broadcast (1 MB)
BITMAP_BITS = 1 << 23


def remove_stop_words(words: DataFrame, stop: DataFrame, word_col: str = "word",
                      case_insensitive: bool = False,
                      max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                      stop_is_table: bool = False,
                      stop_rows: int | None = None, stop_bytes: int = 0) -> DataFrame:
    """Drop rows whose word is in ``stop`` (column ``word``).

    The stop list is written once as a table (unless ``stop_is_table`` says it
    already reads one), so its size check and the join share one computation;
    rows and characters are observed during that write (or given as ``stop_rows`` and
    ``stop_bytes``). A list past the limits is not broadcast itself, but its hashes are, as a bitmap of
    fixed size: a word whose bit is not set is surely not listed and stays where it is, only the others are
    shuffled to the list. The words are then read twice.
    """
    stop_keys = stop.select(F.col("word").alias("_stop"))
    key = F.col(word_col)
    if case_insensitive:
        stop_keys = stop_keys.select(F.lower("_stop").alias("_stop")).distinct()
        key = F.lower(key)
    if not stop_is_table:
        stop_keys, m = materialize_measured(stop_keys, "stop-list", {
            "rows": F.count(F.lit(1)), "chars": F.sum(F.octet_length("_stop").cast("bigint"))})
        stop_rows, stop_bytes = m["rows"], key_table_bytes(m["rows"], 1, m["chars"])
    if stop_rows is None or (stop_rows <= max_broadcast_rows and stop_bytes <= DEFAULT_KEY_BROADCAST_BYTES):
        stop_keys = broadcast_if_small(stop_keys, max_broadcast_rows, known_rows=stop_rows,
                                       known_bytes=stop_bytes)
        return words.join(stop_keys, key == F.col("_stop"), "left_anti")
    sure, doubtful = split_by_bitmap(words, key, stop_keys, "_stop")
    return sure.unionByName(doubtful.join(stop_keys, key == F.col("_stop"), "left_anti"))


def split_by_bitmap(words: DataFrame, key: Column, listed: DataFrame, listed_col: str,
                    bits: int = BITMAP_BITS) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``key`` is surely not in ``listed``, the other rows).

    Every listed value sets the bit of its hash in a bitmap of ``bits`` bits, built by Spark's bitmap
    aggregates as rows of 32,768 bits and broadcast: ``bits / 8`` bytes whatever the length of the list.
    A null key is surely not listed.
    """
    def place(value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(bits))

    hashed = listed.where(F.col(listed_col).isNotNull()).select(place(F.col(listed_col)).alias("_h"))
    maps = hashed.groupBy(F.bitmap_bucket_number("_h").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_h")).alias("_bitmap"))
    h = place(key)
    bit = F.bitmap_bit_position(h)
    byte = F.conv(F.hex(F.substring(F.col("_bitmap"), (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10)
    is_set = F.call_function("shiftright", byte.cast("int"), F.pmod(bit, F.lit(8)).cast("int")).bitwiseAND(F.lit(1))
    marked = (words.join(F.broadcast(maps), F.bitmap_bucket_number(h) == F.col("_bucket"), "left")
              .withColumn("_maybe", F.coalesce(key.isNotNull() & (is_set == 1), F.lit(False)))
              .drop("_bucket", "_bitmap"))
    return marked.where(~F.col("_maybe")).drop("_maybe"), marked.where("_maybe").drop("_maybe")


def term_frequencies(tagged: DataFrame, word_col: str = "word", doc_col: str = "doc") -> DataFrame:
    """(word, doc, tf): occurrences of each word in each document."""
    return (tagged.groupBy(F.col(word_col).alias("word"), F.col(doc_col).alias("doc"))
            .agg(F.count(F.lit(1)).alias("tf")))


def _prepared(tagged: DataFrame, stop: DataFrame | None, max_count: int | None) -> DataFrame:
    """(word, doc, tf) without stop words."""
    if stop is not None:
        tagged = remove_stop_words(tagged, stop, case_insensitive=True)
    return drop_frequent(term_frequencies(tagged), max_count)


def drop_frequent(tf: DataFrame, max_count: int | None) -> DataFrame:
    """(word, doc, tf) rows of words whose total count is at most ``max_count`` (None: all)."""
    if max_count is None:
        return tf
    tf = materialize(tf.select("word", "doc", "tf"), "term-frequencies")
    totals = tf.groupBy("word").agg(F.sum("tf").alias("n")).where(F.col("n") > max_count)
    return remove_stop_words(tf, totals.select("word"))


def inverted_index(tagged: DataFrame, stop: DataFrame | None = None,
                   max_count: int | None = None) -> DataFrame:
    """(word, n_docs, docs): sorted distinct documents containing each word."""
    return _prepared(tagged, stop, max_count).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_docs"), F.array_sort(F.collect_list("doc")).alias("docs"))


def inverted_index_tf(tagged: DataFrame, stop: DataFrame | None = None,
                      max_count: int | None = None) -> DataFrame:
    """(word, postings): ``array<struct<doc, tf>>`` sorted by doc."""
    if stop is not None:
        tagged = remove_stop_words(tagged, stop, case_insensitive=True)
    return index_from_term_frequencies(term_frequencies(tagged), max_count)


def index_from_term_frequencies(tf: DataFrame, max_count: int | None = None) -> DataFrame:
    """(word, postings) from an existing (word, doc, tf) table, e.g. streaming state;
    words whose total count exceeds ``max_count`` are stop words and left out."""
    return drop_frequent(tf, max_count).groupBy("word").agg(
        F.array_sort(F.collect_list(F.struct("doc", "tf"))).alias("postings"))


def posting_blocks(tagged: DataFrame, stop: DataFrame | None = None,
                   max_count: int | None = None, width: int = 4096, tf: bool = False) -> DataFrame:
    """(word, block, n_docs, docs): the index in rows of bounded length; with ``tf`` (word, block, n_docs, postings).

    Integer document ids: block b of a word holds its documents ``b * width`` to
    ``b * width + width - 1``. Document names (strings): the same over the dense ranks of the names in byte
    order, null first. So no row and no group ever holds more than ``width`` documents, even for a word that is
    in every one. Documents of other types are refused.
    """
    counted = _prepared(tagged, stop, max_count)
    kind = counted.schema["doc"].dataType
    if isinstance(kind, T.StringType):
        names, m = materialize_measured(
            dense_ranks(tagged.select("doc").distinct(), ["doc"], alias="_place", name="documents"), "document-ranks",
            {"rows": F.count(F.lit(1)), "chars": F.sum(F.octet_length("doc").cast("bigint"))})
        side = broadcast_if_small(names.withColumnRenamed("doc", "_name"), known_rows=m["rows"],
                                  known_bytes=key_table_bytes(m["rows"], 1, m["chars"]))
        counted = counted.join(side, F.col("doc").eqNullSafe(F.col("_name"))).drop("_name")
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        counted = counted.withColumn("_place", F.col("doc"))
    else:
        raise TypeError(f"posting blocks need integer or string documents, not {kind.simpleString()}")
    # div truncates towards zero; an id below zero belongs to the block before
    block = F.expr(f"_place div {width} - if(_place < 0 and pmod(_place, {width}) > 0, 1, 0)")
    grouped = counted.groupBy("word", block.alias("block"))
    if tf:
        return grouped.agg(F.count(F.lit(1)).alias("n_docs"),
                           F.array_sort(F.collect_list(F.struct("doc", "tf"))).alias("postings"))
    return grouped.agg(F.count(F.lit(1)).alias("n_docs"),
                       F.array_sort(F.collect_list("doc")).alias("docs"))


def document_keys(tagged: DataFrame) -> tuple[DataFrame, Column, dict]:
    """(documents, key, measures): the distinct documents (``_key``, ``_doc``), written once, and an expression for
    the 64-bit key of column ``doc``. The hash is seeded anew until no two of the documents share a key."""
    names, m = materialize_measured(tagged.select(F.col("doc").alias("_doc")).distinct(), "documents", {
        "rows": F.count(F.lit(1)), "chars": F.sum(F.octet_length(F.col("_doc").cast("string")).cast("bigint"))})
    for seed in range(64):
        keys = names.select(F.xxhash64(F.lit(seed), "_doc").alias("_key"), "_doc")
        if keys.select("_key").distinct().count() == m["rows"]:
            return keys, F.xxhash64(F.lit(seed), "doc"), m
    raise RuntimeError("no hash seed tells all documents apart")


def word_spread(tagged: DataFrame, stop: DataFrame | None = None, max_count: int | None = None
                ) -> tuple[DataFrame, DataFrame, dict]:
    """(words, documents, measures): per non-stop word ``n``, its occurrences, and ``_key``, the key of its document if
    it is in one only (else null); documents as of :func:`document_keys`.

    One aggregate with one shuffle of one row per task and word: a word is in one document if the smallest and the
    largest document key are the same, so pairs of word and document need no shuffle of their own, and the
    count that decides on stop words comes from the same group. Keys are numbers, so that the aggregate hashes its words
    and never sorts the occurrences. A null document counts as one.
    """
    documents, key, measures = document_keys(tagged)
    if stop is not None:
        tagged = remove_stop_words(tagged, stop, case_insensitive=True)
    per_word = tagged.select("word", key.alias("_of")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), F.min("_of").alias("_low"), F.max("_of").alias("_high"))
    if max_count is not None:
        per_word = per_word.where(F.col("n") <= max_count)
    return (per_word.select("word", "n", F.when(F.col("_low") == F.col("_high"), F.col("_low")).alias("_key")),
            documents, measures)


def single_document_words(tagged: DataFrame, stop: DataFrame | None = None,
                          max_count: int | None = None) -> DataFrame:
    """(word, doc) for words found in exactly one document."""
    words, documents, m = word_spread(tagged, stop, max_count)
    documents = broadcast_if_small(documents, known_rows=m["rows"],
                                   known_bytes=key_table_bytes(m["rows"], 1, m["chars"]))
    return words.join(documents, "_key").select("word", F.col("_doc").alias("doc"))


def vocabulary_stats(tagged: DataFrame, stop: DataFrame | None = None,
                     max_count: int | None = None) -> DataFrame:
    """One row: unique (non-stop) words and words in a single document."""
    words, _, _ = word_spread(tagged, stop, max_count)
    return words.agg(F.count(F.lit(1)).alias("unique_words"), F.count("_key").alias("single_document_words"))


def render_postings(idx: DataFrame) -> DataFrame:
    """Index rows with their postings as text, decided from the schema (T7, T8):
    ``docs`` → ``a, b``; ``postings`` (doc, tf structs) → ``a#2, b#1``."""
    if "postings" in idx.columns:
        return idx.withColumn("postings", join_tf_postings(F.col("postings")))
    if "docs" in idx.columns:
        return idx.withColumn("docs", join_docs(F.col("docs")))
    return idx

