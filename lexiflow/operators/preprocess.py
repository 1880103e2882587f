"""Preprocessing of line documents for set-similarity joins.

A line becomes a document: the set of its alphanumeric tokens (case kept),
minus stop words, ordered from globally rarest to commonest, ties by word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiflow.functions.text import alnum_tokens
from lexiflow.operators.counts import STOP_WORD_THRESHOLD, word_count
from lexiflow.operators.index import remove_stop_words
from lexiflow.operators.joins import (DEFAULT_BROADCAST_ROWS, DEFAULT_KEY_BROADCAST_BYTES,
                                      key_table_bytes)
from lexiflow.operators.ranks import dense_ranks
from lexiflow.session import materialize_measured


def word_frequency(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """(word, n) over every alphanumeric token occurrence, case kept (A2)."""
    return word_count(lines.select(F.explode(alnum_tokens(text_col)).alias("word")))


def _collapse_ties(ranked):
    """Keep only the greatest word of each run of equal frequency (D9 stand-in)."""
    nxt = lambda i: F.get(ranked, i + 1)  # noqa: E731  next element, NULL past the end
    return F.filter(ranked, lambda x, i: (i == F.size(ranked) - 1) | (nxt(i)["n"] != x["n"]))


def preprocess(lines: DataFrame, id_col: str = "line_id", text_col: str = "value", *,
               stop_threshold: int = STOP_WORD_THRESHOLD, stop: DataFrame | None = None,
               frequencies: DataFrame | None = None, collapse_ties: bool = False,
               max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
               max_broadcast_bytes: int = DEFAULT_KEY_BROADCAST_BYTES) -> DataFrame:
    """(``id_col``, tokens, size) for every non-empty line that keeps a token.

    Frequencies default to this corpus's own counts, and the stop list to the
    words counted more than ``stop_threshold`` times. The vocabulary is
    written once as a table and its size measured. If it is small enough to
    broadcast, one map-side join both drops stop words and attaches counts.
    Otherwise the stop list is broadcast after its own size check (dropping
    stop words before any shuffle) and the frequency join is a shuffle join. With the
    derived stop list it only sees words counted at most ``stop_threshold`` times, so no
    join key can be hot; with a given ``stop`` list only the words it names are removed,
    whatever their counts, and the skew join splits a hot word's rows.

    ``frequencies`` may name a word more than once; its greatest count is used.
    """
    kept = lines.where(F.col(text_col) != "")
    words = kept.select(F.col(id_col).alias("_id"),
                        F.explode(F.array_distinct(alnum_tokens(text_col))).alias("word"))
    derived = frequencies is None
    vocab, m = materialize_measured(
        word_frequency(kept, text_col) if derived
        else frequencies.groupBy("word").agg(F.max("n").alias("n")), "vocabulary",
        {"rows": F.count(F.lit(1)), "chars": F.sum(F.octet_length("word").cast("bigint")),
         "stop_rows": F.count(F.when(F.col("n") > stop_threshold, 1)),
         "stop_chars": F.sum(F.when(F.col("n") > stop_threshold, F.octet_length("word").cast("bigint")))})
    small_vocab = key_table_bytes(m["rows"], 1, m["chars"]) <= max_broadcast_bytes
    if stop is None and derived and small_vocab:
        # one map-side join removes stop words (n > T) and attaches n: no shuffle
        ranked = words.join(F.broadcast(vocab.where(F.col("n") <= stop_threshold)), "word")
    else:
        if stop is None:
            stop = vocab.where(F.col("n") > stop_threshold).select("word")
            words = remove_stop_words(words, stop, max_broadcast_rows=max_broadcast_rows,
                                      stop_is_table=True, stop_rows=m["stop_rows"],
                                      stop_bytes=key_table_bytes(m["stop_rows"], 1, m["stop_chars"]))
            known = vocab.where(F.col("n") <= stop_threshold)
        else:
            words = remove_stop_words(words, stop, max_broadcast_rows=max_broadcast_rows)
            known = vocab
        if derived:
            # inner join: every remaining word is in the vocabulary
            ranked = words.join(F.broadcast(known) if small_vocab else known, "word")
        else:
            side = F.broadcast(vocab) if small_vocab else vocab
            ranked = (words.join(side, "word", "left")
                      .withColumn("n", F.coalesce(F.col("n"), F.lit(0))))
    docs = ranked.groupBy("_id").agg(
        F.array_sort(F.collect_list(F.struct(F.col("n").cast("bigint").alias("n"),
                                             F.col("word")))).alias("_ranked"))
    ordered = _collapse_ties(F.col("_ranked")) if collapse_ties else F.col("_ranked")
    tokens = F.transform(ordered, lambda x: x["word"])
    return docs.select(F.col("_id").alias(id_col), tokens.alias("tokens"),
                       F.size(tokens).alias("size"))


def _vocabulary(kept: DataFrame, text_col: str, stop_threshold: int) -> tuple[DataFrame, dict]:
    """(word, n) of the lines' words, written once, with its row and byte counts."""
    return materialize_measured(word_frequency(kept, text_col), "vocabulary", {
        "rows": F.count(F.lit(1)), "known": F.count(F.when(F.col("n") <= stop_threshold, 1)),
        "chars": F.sum(F.when(F.col("n") <= stop_threshold, F.octet_length("word").cast("bigint")))})


def rank_dictionary(vocab: DataFrame, known: int) -> DataFrame:
    """(word, n, rank): dense ranks of the ``known`` words of ``vocab(word, n)`` by (n, word), rarest 0.

    The order of tokens in a document, as one integer per word. Ranges of words are
    sorted where they lie and offset by the sizes of the ranges before them, so no task holds more
    than a range; ranks are ``int`` as long as they fit.
    """
    ranked = dense_ranks(vocab.select("word", "n"), ["n", "word"], alias="rank", name="dictionary")
    return ranked.withColumn("rank", F.col("rank").cast("int" if known < 1 << 31 else "bigint"))


def preprocess_ranked(lines: DataFrame, id_col: str = "line_id", text_col: str = "value", *,
                      stop_threshold: int = STOP_WORD_THRESHOLD,
                      max_broadcast_bytes: int = DEFAULT_KEY_BROADCAST_BYTES
                      ) -> tuple[DataFrame, DataFrame]:
    """(docs, dictionary): :func:`preprocess` with every token as its rank in the global order.

    ``docs`` has (``id_col``, tokens, size) with ``tokens`` ascending ranks, the same documents in the same
    order as the words of :func:`preprocess`; ``dictionary`` has (word, n, rank). The dictionary holds the words
    counted at most ``stop_threshold`` times, so its join is also the stop filter; it is
    broadcast below the checked size, else words and dictionary are shuffled, and no key of that join is hot. A
    task then looks words up in its part of the dictionary, which has one row per word, and sorts no words.
    """
    kept = lines.where(F.col(text_col) != "")
    words = kept.select(F.col(id_col).alias("_id"),
                        F.explode(F.array_distinct(alnum_tokens(text_col))).alias("word"))
    vocab, m = _vocabulary(kept, text_col, stop_threshold)
    dictionary = rank_dictionary(vocab.where(F.col("n") <= stop_threshold), m["known"])
    small = key_table_bytes(m["known"], 1, m["chars"]) <= max_broadcast_bytes
    if not small:
        # frequent words go before the shuffle
        stop, stop_m = materialize_measured(
            vocab.where(F.col("n") > stop_threshold).select(F.col("word").alias("_stop")), "stop-list",
            {"rows": F.count(F.lit(1)), "chars": F.sum(F.octet_length("_stop").cast("bigint"))})
        words = remove_stop_words(words, stop.withColumnRenamed("_stop", "word"), stop_is_table=True,
                                  stop_rows=stop_m["rows"],
                                  stop_bytes=key_table_bytes(stop_m["rows"], 1, stop_m["chars"]))
    side = dictionary.select("word", "rank")
    ranked = words.join(F.broadcast(side) if small else side.hint("shuffle_hash"), "word").select("_id", "rank")
    docs = ranked.groupBy("_id").agg(F.sort_array(F.collect_list("rank")).alias("tokens"))
    return docs.select(F.col("_id").alias(id_col), "tokens", F.size("tokens").alias("size")), dictionary


def document_count(processed: DataFrame) -> DataFrame:
    """One row: number of retained documents."""
    return processed.agg(F.count(F.lit(1)).alias("n_documents"))
