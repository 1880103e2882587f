"""lexiflow — text-index and set-similarity analytics as Spark DataFrame jobs.

Modules:
  functions  column expressions (tokenize, set similarity, renderings)
  sources    text-file / table-line scans, side-input readers
  sinks      delimited text writers
  operators  counts, inverted indexes, preprocessing, similarity joins
  plans      named queries over the test tables and their SQL oracles
  streaming  incremental versions of the counting jobs

The main entry points are re-exported here.
"""

from lexiflow.functions.sets import JACCARD, OVERLAP_RATIO, Threshold
from lexiflow.functions.text import first_letter, tokenize
from lexiflow.operators.counts import (count_words, explode_tokens, first_letter_count,
                                       frequent_words, job_counters, stop_words, top_words, word_count)
from lexiflow.operators.index import (inverted_index, inverted_index_tf, posting_blocks,
                                      remove_stop_words, render_postings, single_document_words,
                                      vocabulary_stats)
from lexiflow.operators.preprocess import (document_count, preprocess, preprocess_ranked,
                                            rank_dictionary, word_frequency)
from lexiflow.operators.ranks import dense_ranks, prefix_sums
from lexiflow.operators.similarity import (all_pairs, all_pairs_stats, candidate_pairs,
                                           comparison_stats, prefix_index, similar_sets,
                                           similarity_join)
from lexiflow.sinks.delimited import write_delimited, write_scalar
from lexiflow.sources.lines import lines_from_documents, number_lines, read_lines
from lexiflow.sources.side_inputs import (read_processed, read_scalar, read_stop_list,
                                          read_word_counts)

__version__ = "0.1.0"

__all__ = [
    "JACCARD", "OVERLAP_RATIO", "Threshold", "first_letter", "tokenize", "count_words",
    "explode_tokens", "first_letter_count", "frequent_words", "job_counters", "stop_words", "top_words",
    "word_count", "inverted_index", "inverted_index_tf", "posting_blocks", "remove_stop_words", "render_postings",
    "single_document_words", "vocabulary_stats", "document_count", "preprocess", "preprocess_ranked", "rank_dictionary",
    "dense_ranks", "prefix_sums",
    "word_frequency", "all_pairs", "all_pairs_stats", "candidate_pairs", "comparison_stats",
    "prefix_index", "similar_sets", "similarity_join", "write_delimited", "write_scalar", "lines_from_documents",
    "number_lines", "read_lines", "read_processed", "read_scalar", "read_stop_list",
    "read_word_counts",
]
