"""Queries that write results as text files and read them back (sinks and side inputs).

Each writes into a fresh folder under the shared checkpoint folder, in the
reference's file layouts, then re-reads it with the matching reader, so the
result must equal the in-memory query it started from.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiflow.functions.render import join_docs, join_tokens, pair_line
from lexiflow.operators import counts, preprocess, similarity
from lexiflow.operators.index import inverted_index, single_document_words
from lexiflow.plans import catalog
from lexiflow.session import scratch_path
from lexiflow.sinks.delimited import ARROW, COMMA, TAB, write_delimited, write_scalar
from lexiflow.sources.lines import number_lines, read_lines
from lexiflow.sources.side_inputs import (read_processed, read_scalar, read_stop_list,
                                          read_word_counts)
from lexiflow.sources.tables import document_texts

# number of output files of the multi-file sink (the reference used 10 reducers)
N_OUTPUT_FILES = 10


def text_round_trip_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-letter counts as ``letter<TAB>n`` in one sorted file."""
    path = scratch_path(spark, "first_letter")
    write_delimited(catalog.first_letter_count(spark, sf_dir), path, "letter", "n", sep=TAB,
                    n_files=1)
    return read_word_counts(spark, path, sep=TAB).withColumnRenamed("word", "letter")


def text_round_trip_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case-kept word counts as ``word,n`` over 10 key-partitioned sorted files (K2, K7, K8)."""
    path = scratch_path(spark, "word_frequency")
    write_delimited(catalog.word_count_clean(spark, sf_dir), path, "word", "n", sep=COMMA,
                    n_files=N_OUTPUT_FILES)
    return read_word_counts(spark, path, sep=COMMA)


def stop_list_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop list written as ``word,n`` then read as a stop list: words only."""
    path = scratch_path(spark, "stop_words")
    write_delimited(catalog.stop_words_case(spark, sf_dir), path, "word", "n", sep=COMMA)
    return read_stop_list(spark, path, sep=COMMA)


def inverted_index_stop_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index job as the reference runs it: a stop list, case kept, is written as ``word,n``
    files, read back (S4) and removed without regard to case with an anti-join (J1, F2)."""
    path = scratch_path(spark, "stop_words_case")
    write_delimited(catalog.stop_words_case(spark, sf_dir), path, "word", "n", sep=COMMA)
    stop = read_stop_list(spark, path)
    idx = inverted_index(catalog.tagged_words(spark, sf_dir), stop=stop)
    return idx.select("word", "n_docs", join_docs(F.col("docs")).alias("docs"))


def text_round_trip_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inverted index as ``word => a, b`` (K3), read back and split at the arrow."""
    path = scratch_path(spark, "inverted_index")
    write_delimited(catalog.inverted_index(spark, sf_dir), path, "word", "docs", sep=ARROW)
    back = spark.read.text(path)
    parts = F.split("value", ARROW, 2)
    return back.select(F.get(parts, 0).alias("word"), F.get(parts, 1).alias("docs"))


def text_round_trip_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed documents as ``id,t1;t2`` (K2, T6), read back as token arrays."""
    path = scratch_path(spark, "processed")
    write_delimited(catalog.preprocess_documents(spark, sf_dir), path, "doc_id", "tokens",
                    sep=COMMA, total_order=True)
    back = read_processed(spark, path)
    return back.select("doc_id", join_tokens(F.col("tokens")).alias("tokens"))


def similar_pairs_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similar pairs written as ``a,b, similarity : x`` lines (T14), read back and parsed."""
    path = scratch_path(spark, "similar_pairs")
    pairs = catalog.similar_pairs_prefix(spark, sf_dir)
    # lines are made after the shuffle, which carries numbers only, and compressed: pairs grow faster than their documents
    (pairs.repartitionByRange("doc_a", "doc_b").sortWithinPartitions("doc_a", "doc_b")
     .select(pair_line(F.col("doc_a"), F.col("doc_b"), F.col("similarity")).alias("value"))
     .write.text(path, compression="gzip"))
    pattern = r"^(\d+),(\d+), similarity : (.*)$"
    back = spark.read.text(path)
    return back.select(F.regexp_extract("value", pattern, 1).try_cast("bigint").alias("doc_a"),
                       F.regexp_extract("value", pattern, 2).try_cast("bigint").alias("doc_b"),
                       F.regexp_extract("value", pattern, 3).alias("similarity"))


def _chained_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's preprocessing chain glued by files: word frequencies and
    the stop list are written as ``word,n`` files, read back (S4, S5) and
    given to the preprocessing job as external side inputs (J1, J2)."""
    freq_path = scratch_path(spark, "word_frequency")
    stop_path = scratch_path(spark, "stop_words")
    write_delimited(catalog.word_count_clean(spark, sf_dir), freq_path, "word", "n", sep=COMMA,
                    n_files=N_OUTPUT_FILES)
    write_delimited(catalog.stop_words_case(spark, sf_dir), stop_path, "word", "n", sep=COMMA)
    lines = catalog.document_lines(spark, sf_dir).select("line_id", "value")
    out = preprocess.preprocess(lines, "line_id", "value",
                                stop=read_stop_list(spark, stop_path),
                                frequencies=read_word_counts(spark, freq_path))
    return out.withColumnRenamed("line_id", "doc_id")


def preprocess_chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preprocessing from frequency and stop-list files (E2): (doc_id, tokens)."""
    return _chained_processed(spark, sf_dir).select(
        "doc_id", join_tokens(F.col("tokens")).alias("tokens"))


def preprocess_stop_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preprocessing from a stop-list file alone (S4, J1), frequencies derived.

    The file names only the words above the reference's threshold; the operator's own threshold is
    lower and must not remove any other word.
    """
    path = scratch_path(spark, "stop_words")
    listed = counts.stop_words(catalog.word_count_clean(spark, sf_dir), counts.STOP_WORD_THRESHOLD)
    write_delimited(listed, path, "word", "n", sep=COMMA)
    lines = catalog.document_lines(spark, sf_dir).select("line_id", "value")
    out = preprocess.preprocess(lines, "line_id", "value", stop_threshold=catalog.LIST_THRESHOLD,
                                stop=read_stop_list(spark, path))
    return out.select(F.col("line_id").alias("doc_id"), join_tokens(F.col("tokens")).alias("tokens"))


def similar_pairs_chained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix similarity join reading the preprocessed ``id,t1;t2`` file (E2 -> E3, S6)."""
    path = scratch_path(spark, "processed")
    write_delimited(preprocess_chained(spark, sf_dir), path, "doc_id", "tokens", sep=COMMA)
    docs = read_processed(spark, path)
    # the files' tokens were counted at most LIST_THRESHOLD times, which bounds every posting list
    return similarity.similarity_join(docs, catalog.PREFIX_THRESHOLD,
                                      posting_bound=catalog.LIST_THRESHOLD)


def document_count_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document count written as a one-line file, overwriting (K4, K6), read back."""
    path = scratch_path(spark, "document_count")
    n = preprocess.document_count(catalog.processed_lines(spark, sf_dir))
    write_scalar(n, path)
    write_scalar(n, path, mode="overwrite")  # a second run replaces the file
    return read_scalar(spark, path, "n_documents")


def _write_corpus_files(spark: SparkSession, sf_dir: str) -> str:
    """Write every document's text into text files, one folder per ``source``."""
    path = scratch_path(spark, "corpus")
    (document_texts(spark, sf_dir).select("source", "text")
     .write.partitionBy("source").text(path))
    return path


def corpus_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-file corpus scan (S1, S2, U4): lines and words per source folder."""
    path = _write_corpus_files(spark, sf_dir)
    lines = spark.read.text(path)  # partition discovery restores ``source``
    words = F.size(F.regexp_extract_all("value", F.lit("[A-Za-z0-9]+"), 0))
    return (lines.groupBy(F.col("source").alias("doc"))
            .agg(F.count(F.lit(1)).alias("n_lines"), F.sum(words).cast("bigint").alias("n_words")))


def file_name_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File-name-tagged scan (S3): words found in exactly one source of the corpus.

    The document of a line is taken from the path of the file it was read
    from (its ``source=<name>`` folder), through the scan's ``_metadata``.
    """
    path = _write_corpus_files(spark, sf_dir)
    tagged = read_lines(spark, path, with_file=True, full_path=True)
    tagged = tagged.select(F.regexp_extract("doc", "source=([^/]+)/[^/]*$", 1).alias("doc"),
                           "value")
    words = counts.explode_tokens(tagged, "value", clean=True, lower=True, keep=("doc",))
    return single_document_words(words, max_count=catalog.QUERY_STOP_THRESHOLD)


def _write_named_files(spark: SparkSession, sf_dir: str) -> str:
    """Write every source's texts into one text file that is named after the source."""
    folders, files = scratch_path(spark, "by-source"), scratch_path(spark, "named")
    texts = document_texts(spark, sf_dir).select("source", "text")
    texts.repartition("source").write.partitionBy("source").text(folders)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folders).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(files))
    for folder in fs.listStatus(path(folders)):
        key, _, name = folder.getPath().getName().partition("=")
        for n, part in enumerate(fs.listStatus(folder.getPath()) if key == "source" else []):
            fs.rename(part.getPath(), path(files, f"{unquote(name)}{'.' + str(n) if n else ''}"))
    return files


def base_name_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inverted index over files by base name (S3, A7): the document of a line is the file it was read from."""
    lines = read_lines(spark, _write_named_files(spark, sf_dir), with_file=True)
    words = counts.explode_tokens(lines, "value", clean=True, lower=True, keep=("doc",))
    idx = inverted_index(words, max_count=catalog.QUERY_STOP_THRESHOLD)
    return idx.select("word", "n_docs", join_docs(F.col("docs")).alias("docs"))


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense line numbers over text files in file order (P5, F1): (line_id, line)."""
    path = scratch_path(spark, "ordered_corpus")
    texts = document_texts(spark, sf_dir).select("doc_id", "text")
    n_files = spark.sparkContext.defaultParallelism
    (texts.repartitionByRange(n_files, "doc_id").sortWithinPartitions("doc_id")
     .select(F.col("text").alias("value")).write.text(path))
    return number_lines(spark, path).select("line_id", F.col("value").alias("line"))


ROUND_TRIP_QUERIES = {
    "text_round_trip_tab": text_round_trip_tab,
    "text_round_trip_comma": text_round_trip_comma,
    "stop_list_round_trip": stop_list_round_trip,
    "inverted_index_stop_file": inverted_index_stop_file,
    "text_round_trip_arrow": text_round_trip_arrow,
    "text_round_trip_processed": text_round_trip_processed,
    "document_count_round_trip": document_count_round_trip,
    "similar_pairs_text": similar_pairs_text,
    "preprocess_chained": preprocess_chained,
    "preprocess_stop_file": preprocess_stop_file,
    "similar_pairs_chained": similar_pairs_chained,
    "corpus_from_files": corpus_from_files,
    "file_name_index": file_name_index,
    "base_name_index": base_name_index,
    "numbered_lines": numbered_lines,
}


# --- streaming --------------------------------------------------------------------

STREAM_FILES = 16
STREAM_FILES_PER_TRIGGER = 4
# a batch of few files is read by as many tasks as there are row groups in them
STREAM_ROW_GROUP_BYTES = 4 * 1024 * 1024


def _in_stream_files(texts: DataFrame) -> DataFrame:
    """Rows dealt evenly to STREAM_FILES partitions, by row number: a plain repartition sorts whole texts first."""
    return (texts.withColumn("_row", F.monotonically_increasing_id())
            .repartition(STREAM_FILES, "_row").drop("_row"))


def _write_stream_input(spark: SparkSession, sf_dir: str) -> str:
    """The documents' text as STREAM_FILES text files, arriving as a file stream."""
    path = scratch_path(spark, "stream-in")
    _in_stream_files(document_texts(spark, sf_dir).select(F.col("text").alias("value"))).write.text(path)
    return path


def streaming_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case-kept word counts kept up to date by a streaming query, 4 files per batch."""
    from lexiflow.streaming.incremental import incremental_word_count
    return incremental_word_count(spark, _write_stream_input(spark, sf_dir),
                                  max_files_per_trigger=STREAM_FILES_PER_TRIGGER)


def streaming_stop_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-cased stop words (count > threshold) from the same streaming plan."""
    from lexiflow.streaming.incremental import incremental_word_count
    return incremental_word_count(spark, _write_stream_input(spark, sf_dir), lower=True,
                                  min_count=catalog.LIST_THRESHOLD,
                                  max_files_per_trigger=STREAM_FILES_PER_TRIGGER)


def streaming_inverted_index_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Term-frequency index kept by a streaming query over arriving parquet files."""
    from lexiflow.functions.render import join_tf_postings
    from lexiflow.streaming.incremental import incremental_inverted_index_tf
    path = scratch_path(spark, "stream-docs")
    (_in_stream_files(document_texts(spark, sf_dir).select("source", "text"))
     .write.option("parquet.block.size", STREAM_ROW_GROUP_BYTES).parquet(path))
    idx = incremental_inverted_index_tf(spark, path, "source string, text string",
                                        max_count=catalog.QUERY_STOP_THRESHOLD,
                                        max_files_per_trigger=STREAM_FILES_PER_TRIGGER)
    return idx.select("word", join_tf_postings(F.col("postings")).alias("postings"))


ROUND_TRIP_QUERIES.update({
    "streaming_inverted_index_tf": streaming_inverted_index_tf,
    "streaming_word_count": streaming_word_count,
    "streaming_stop_words": streaming_stop_words,
})
