"""Named queries over the test tables, one per job of the reference.

Every query reads whole tables (``documents`` text, split into lines where the
job treats lines as documents) and returns a DataFrame whose columns are
aliased exactly like the matching SQL in :mod:`lexiflow.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiflow.functions.render import join_docs, join_tf_postings, join_tokens
from lexiflow.functions.sets import OVERLAP_RATIO, Threshold
from lexiflow.operators import counts, index, preprocess, similarity
from lexiflow.sources.lines import LINE_ID_STRIDE
from lexiflow.sources.tables import (document_lines, document_texts, multi_corpus_texts,
                                     tagged_texts)

# Parameters of the test queries. Texts are processed at the reference's own stop
# threshold; the stop-word lists are reported at 400, since 4000 finds almost none on small tables.
QUERY_STOP_THRESHOLD = counts.STOP_WORD_THRESHOLD
LIST_THRESHOLD = 400
BLOCK_WIDTH = 500
NAME_BLOCK_WIDTH = 2
# line ids of 100 documents
PREFIX_BLOCK_IDS = 100 * LINE_ID_STRIDE
PREFIX_THRESHOLD = Threshold.of("4/5")
ALL_PAIRS_THRESHOLD = Threshold.of("1/2")
OVERLAP_RATIO_THRESHOLD = Threshold.of("1/4", measure=OVERLAP_RATIO)
TOP_K = 100
SAMPLE_LINES = 1000


# --- counts -----------------------------------------------------------------

def word_count_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = document_texts(spark, sf_dir)
    return counts.count_words(texts, "text", clean=True)


def word_count_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = document_lines(spark, sf_dir)
    return counts.count_words(lines, "value", clean=False, keep_empty=True)


def word_count_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = document_texts(spark, sf_dir)
    return counts.count_words(texts, "text", clean=True, lower=True)


def first_letter_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = document_lines(spark, sf_dir)
    words = counts.explode_tokens(lines, "value", clean=False, keep_empty=True)
    return counts.first_letter_count(words)


def stop_words_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.stop_words(word_count_lower(spark, sf_dir), LIST_THRESHOLD)


def stop_words_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.stop_words(word_count_clean(spark, sf_dir), LIST_THRESHOLD)


def stop_words_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The case-kept stop list, counted by hash buckets first."""
    texts = document_texts(spark, sf_dir)
    return counts.frequent_words(counts.explode_tokens(texts, "text", clean=True), LIST_THRESHOLD)


def word_count_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = document_lines(spark, sf_dir)
    return counts.job_counters(lines, "value", clean=False, keep_empty=True)


def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.top_words(word_count_clean(spark, sf_dir), TOP_K)


# --- inverted indexes ---------------------------------------------------------

def tagged_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, word): lower-cased alphanumeric tokens tagged with the source."""
    return counts.explode_tokens(tagged_texts(spark, sf_dir), "value", clean=True,
                                 lower=True, keep=("doc",))


def inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = index.inverted_index(tagged_words(spark, sf_dir), max_count=QUERY_STOP_THRESHOLD)
    return idx.select("word", "n_docs", join_docs(F.col("docs")).alias("docs"))


def inverted_index_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = index.inverted_index_tf(tagged_words(spark, sf_dir), max_count=QUERY_STOP_THRESHOLD)
    return idx.select("word", join_tf_postings(F.col("postings")).alias("postings"))


def multi_corpus_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inverted index over the union of three corpora (U4), stop words removed."""
    words = counts.explode_tokens(multi_corpus_texts(spark, sf_dir), "value", clean=True,
                                  lower=True, keep=("doc",))
    idx = index.inverted_index(words, max_count=QUERY_STOP_THRESHOLD)
    return idx.select("word", "n_docs", join_docs(F.col("docs")).alias("docs"))


def posting_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word's documents, by ``doc_id`` and with no word left out, in rows of bounded length."""
    texts = document_texts(spark, sf_dir).selectExpr("doc_id AS doc", "text AS value")
    words = counts.explode_tokens(texts, "value", clean=True, lower=True, keep=("doc",))
    idx = index.posting_blocks(words, width=BLOCK_WIDTH)
    return idx.select("word", "block", "n_docs", F.array_join("docs", ", ").alias("docs"))


def posting_blocks_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index by ``doc_id`` with term frequencies, in rows of bounded length."""
    texts = document_texts(spark, sf_dir).selectExpr("doc_id AS doc", "text AS value")
    words = counts.explode_tokens(texts, "value", clean=True, lower=True, keep=("doc",))
    idx = index.posting_blocks(words, width=BLOCK_WIDTH, tf=True)
    return idx.select("word", "block", "n_docs", join_tf_postings(F.col("postings")).alias("postings"))


def posting_blocks_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index by file name with term frequencies, in rows of at most NAME_BLOCK_WIDTH names."""
    idx = index.posting_blocks(tagged_words(spark, sf_dir), width=NAME_BLOCK_WIDTH, tf=True)
    return idx.select("word", "block", "n_docs", join_tf_postings(F.col("postings")).alias("postings"))


def single_document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.single_document_words(tagged_words(spark, sf_dir),
                                       max_count=QUERY_STOP_THRESHOLD)


def vocabulary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.vocabulary_stats(tagged_words(spark, sf_dir), max_count=QUERY_STOP_THRESHOLD)


# --- preprocessing ------------------------------------------------------------

def processed_lines(spark: SparkSession, sf_dir: str, collapse_ties: bool = False) -> DataFrame:
    """(doc_id, tokens, size): every line of ``documents`` as a token-set document."""
    lines = document_lines(spark, sf_dir).select("line_id", "value")
    out = preprocess.preprocess(lines, "line_id", "value", stop_threshold=QUERY_STOP_THRESHOLD,
                                collapse_ties=collapse_ties)
    return out.withColumnRenamed("line_id", "doc_id")


def ranked_lines_and_words(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, tokens, size) as :func:`processed_lines`, with ranks for tokens, and (word, n, rank) of all ranks."""
    lines = document_lines(spark, sf_dir).select("line_id", "value")
    docs, words = preprocess.preprocess_ranked(lines, "line_id", "value", stop_threshold=QUERY_STOP_THRESHOLD)
    return docs.withColumnRenamed("line_id", "doc_id"), words


def ranked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, tokens, size) as :func:`processed_lines`, with ranks in the global order for tokens."""
    return ranked_lines_and_words(spark, sf_dir)[0]


def preprocess_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed_lines(spark, sf_dir).select("doc_id", join_tokens(F.col("tokens"))
                                                 .alias("tokens"))


def preprocess_ties_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processed_lines(spark, sf_dir, collapse_ties=True).select(
        "doc_id", join_tokens(F.col("tokens")).alias("tokens"))


def document_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preprocess.document_count(processed_lines(spark, sf_dir))


# --- similarity joins -----------------------------------------------------------

def prefix_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = similarity.prefix_index(processed_lines(spark, sf_dir), PREFIX_THRESHOLD)
    return idx.select("word", "n_docs", F.array_join("docs", ", ").alias("docs"))


def prefix_index_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix index in rows that span PREFIX_BLOCK_IDS line ids each."""
    docs, dictionary = ranked_lines_and_words(spark, sf_dir)
    idx = similarity.prefix_index_blocks(docs, PREFIX_THRESHOLD, width=PREFIX_BLOCK_IDS, dictionary=dictionary)
    return idx.select("word", "block", "n_docs", F.array_join("docs", ", ").alias("docs"))


def similar_pairs_naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs with Jaccard >= 1/2: the rows of a full comparison, from prefix candidates."""
    return similarity.similarity_join(ranked_lines(spark, sf_dir), ALL_PAIRS_THRESHOLD)


def similar_pairs_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.similarity_join(ranked_lines(spark, sf_dir), PREFIX_THRESHOLD)


def similar_pairs_overlap_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.similarity_join(ranked_lines(spark, sf_dir), OVERLAP_RATIO_THRESHOLD)


def similar_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of different token sets with Jaccard >= 4/5, each set named by its smallest document."""
    return similarity.similar_sets(ranked_lines(spark, sf_dir), PREFIX_THRESHOLD)[0]


def similar_set_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token set of every document: a cluster of k copies is k rows, not its pairs."""
    return similarity.similar_sets(ranked_lines(spark, sf_dir), PREFIX_THRESHOLD)[1]


def comparison_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.comparison_stats(ranked_lines(spark, sf_dir), PREFIX_THRESHOLD)


def all_pairs_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.all_pairs_stats(ranked_lines(spark, sf_dir))


# --- sampling -------------------------------------------------------------------

def sample_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first lines by id: the reference's hand-made sample, as a limit."""
    lines = document_lines(spark, sf_dir)
    return lines.orderBy("line_id").limit(SAMPLE_LINES).select(
        F.col("line_id").alias("doc_id"), F.col("value").alias("line"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "word_count_clean": word_count_clean,
    "word_count_raw": word_count_raw,
    "word_count_lower": word_count_lower,
    "first_letter_count": first_letter_count,
    "stop_words_lower": stop_words_lower,
    "stop_words_case": stop_words_case,
    "stop_words_bucketed": stop_words_bucketed,
    "top_words": top_words,
    "word_count_counters": word_count_counters,
    "inverted_index": inverted_index,
    "inverted_index_tf": inverted_index_tf,
    "multi_corpus_index": multi_corpus_index,
    "posting_blocks": posting_blocks,
    "posting_blocks_tf": posting_blocks_tf,
    "posting_blocks_by_name": posting_blocks_by_name,
    "single_document_words": single_document_words,
    "vocabulary_stats": vocabulary_stats,
    "preprocess_documents": preprocess_documents,
    "preprocess_ties_collapsed": preprocess_ties_collapsed,
    "document_count": document_count,
    "prefix_index": prefix_index,
    "prefix_index_blocks": prefix_index_blocks,
    "similar_pairs_naive": similar_pairs_naive,
    "similar_pairs_prefix": similar_pairs_prefix,
    "similar_pairs_overlap_ratio": similar_pairs_overlap_ratio,
    "similar_sets": similar_sets,
    "similar_set_members": similar_set_members,
    "comparison_stats": comparison_stats,
    "all_pairs_stats": all_pairs_stats,
    "sample_lines": sample_lines,
}


def _register_round_trips() -> None:
    from lexiflow.plans.round_trips import ROUND_TRIP_QUERIES
    QUERIES.update(ROUND_TRIP_QUERIES)


_register_round_trips()
