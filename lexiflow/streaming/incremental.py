"""Incremental counting over text files that keep arriving in a folder.

The reference's jobs read a finished folder. The same counting plan runs
here as a Structured Streaming query over a file source: each micro-batch
tokenizes only the new files, and Spark's state store keeps the running count
per word. The checkpoint (offsets + state) lives in the shared checkpoint
folder, so a restarted query — or one that lost executors — resumes exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiflow.functions.text import tokens
from lexiflow.session import scratch_path


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None
                 ) -> DataFrame:
    """Streaming scan of the text files under ``path``: one row per line (``value``)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def running_word_count(lines: DataFrame, text_col: str = "value", *, clean: bool = True,
                       lower: bool = False, keep_empty: bool = False,
                       min_count: int | None = None) -> DataFrame:
    """Streaming (word, n); with ``min_count`` only words counted more than it (stop words)."""
    words = tokens(lines, text_col, clean=clean, lower=lower, keep_empty=keep_empty)
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts if min_count is None else counts.where(F.col("n") > min_count)


def run_to_parquet(counts: DataFrame, out_path: str, checkpoint_path: str,
                   available_now: bool = True):
    """Run a streaming aggregate in update mode: each micro-batch appends only the
    rows whose value changed, under ``out_path/epoch=<id>``.

    Writing an epoch's folder with overwrite makes a replayed epoch (after a
    failure) idempotent; :func:`read_latest` folds the epochs into the current
    table. ``available_now`` processes everything present and stops, in as
    many micro-batches as the source options ask for.
    """
    def publish(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/epoch={epoch}")

    folder, fs = _folder(counts.sparkSession, out_path)
    fs.mkdirs(folder)
    writer = (counts.writeStream.outputMode("update").foreachBatch(publish)
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def _folder(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def read_latest(spark: SparkSession, out_path: str, key: str | list[str] = "word",
                empty_schema: str = "word string, n bigint") -> DataFrame:
    """Current value per key: the row of the newest epoch (counts only grow).

    A folder without any epoch yet (an empty input) gives an empty table; a path that
    does not exist is an error.
    """
    keys = [key] if isinstance(key, str) else list(key)
    folder, fs = _folder(spark, out_path)
    if fs.exists(folder) and not fs.listStatus(folder):
        return spark.createDataFrame([], empty_schema)
    rows = spark.read.parquet(out_path)
    values = [c for c in rows.columns if c not in (*keys, "epoch")]
    return rows.groupBy(*keys).agg(*[F.max_by(c, "epoch").alias(c) for c in values])


def incremental_word_count(spark: SparkSession, path: str, *, clean: bool = True,
                           lower: bool = False, keep_empty: bool = False,
                           min_count: int | None = None,
                           max_files_per_trigger: int | None = None) -> DataFrame:
    """Count the words of every file under ``path`` with a streaming query, then
    return the current result as a batch DataFrame."""
    out = scratch_path(spark, "stream-out")
    ckpt = scratch_path(spark, "stream-ckpt")
    counts = running_word_count(stream_lines(spark, path, max_files_per_trigger), clean=clean,
                                lower=lower, keep_empty=keep_empty, min_count=min_count)
    query = run_to_parquet(counts, out, ckpt)
    query.awaitTermination()
    return read_latest(spark, out)


def running_term_frequencies(tagged_lines: DataFrame, text_col: str = "value",
                             doc_col: str = "doc") -> DataFrame:
    """Streaming (word, doc, tf) of lower-cased alphanumeric tokens: the state
    of an inverted index, one row per (word, document) pair."""
    words = tokens(tagged_lines, text_col, clean=True, lower=True, keep=(F.col(doc_col).alias("doc"),))
    return words.groupBy("word", "doc").agg(F.count(F.lit(1)).alias("tf"))


def incremental_inverted_index_tf(spark: SparkSession, path: str, schema: str,
                                  text_col: str = "text", doc_col: str = "source", *,
                                  max_count: int | None = None,
                                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Term-frequency index of the parquet files arriving under ``path``.

    The streaming query keeps (word, doc) -> tf in its state store and writes
    only changed pairs per micro-batch; the index is folded from the newest
    values on read, with stop words (total count above ``max_count``) removed
    as in the batch job.
    """
    from lexiflow.operators.index import index_from_term_frequencies

    out = scratch_path(spark, "stream-index-out")
    ckpt = scratch_path(spark, "stream-index-ckpt")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    tf = running_term_frequencies(reader.parquet(path), text_col, doc_col)
    query = run_to_parquet(tf, out, ckpt)
    query.awaitTermination()
    state = read_latest(spark, out, ["word", "doc"], "word string, doc string, tf bigint")
    return index_from_term_frequencies(state, max_count)
