"""Line-oriented scans: text files, and lines of a text column of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiflow.functions.text import split_lines

# Lines of document ``d`` get ids ``d * LINE_ID_STRIDE + line_no`` (line_no from 1).
LINE_ID_STRIDE = 1_000_000
# A text is under 2**31 bytes, so under 10**12 lines; with a 19-digit id that is 31 digits.
WIDE_STRIDE = 10 ** 12


def read_lines(spark: SparkSession, path: str | list[str], with_file: bool = False,
               full_path: bool = False) -> DataFrame:
    """One row per line of every text file under ``path``.

    ``with_file`` adds ``doc``: the base name of the containing file (or the
    full path with ``full_path``) as it is on disk, taken from the hidden ``_metadata``
    column. The line reader drops a UTF-8 byte-order mark.
    """
    df = spark.read.text(path)
    if not with_file:
        return df
    name = "_metadata.file_path" if full_path else "_metadata.file_name"
    return df.select("value", plain_name(F.col(name)).alias("doc"))


def plain_name(encoded: Column) -> Column:
    """A file name or path as on disk: ``_metadata`` holds it percent-encoded, plus signs bare."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def number_lines(spark: SparkSession, path: str | list[str], skip_empty: bool = True,
                 with_file: bool = True, max_broadcast_blocks: int = 200_000) -> DataFrame:
    """Dense, file-ordered line ids over text files, without shuffling the lines (P5).

    Each (file, block) split is read by exactly one task, in order, so after
    the empty-line filter ``monotonically_increasing_id`` is consecutive inside
    a split. A per-split table (one row per ~128 MB block) carries the first
    scan id and the lines of all earlier splits; joining it back numbers every line.
    The splits are ranked by a range sort and their lines summed up in ranges of splits, so not even
    that table comes to one task. It is written and its
    size checked before it is broadcast; past the limit it is a shuffle join.
    Output: ``line_id`` (1-based, dense over kept lines), ``value``, ``doc``.
    """
    from lexiflow.operators.joins import broadcast_if_small
    from lexiflow.operators.ranks import dense_ranks, prefix_sums
    from lexiflow.session import materialize_measured

    df = spark.read.text(path)
    if skip_empty:
        df = df.where(F.col("value") != "")
    df = df.select("value",
                   F.col("_metadata.file_path").alias("_path"),
                   plain_name(F.col("_metadata.file_name")).alias("doc"),
                   F.col("_metadata.file_block_start").alias("_block"),
                   F.monotonically_increasing_id().alias("_scan"))
    per_block = df.groupBy("_path", "_block").agg(F.count(F.lit(1)).alias("_n"),
                                                  F.min("_scan").alias("_first"))
    blocks, seen = materialize_measured(per_block, "line-blocks", {"rows": F.count(F.lit(1))})
    ranked = dense_ranks(blocks, ["_path", "_block"], alias="_place", name="line-block-order")
    summed = prefix_sums(ranked, "_place", "_n", max(0, seen["rows"] - 1))
    offsets, m = materialize_measured(
        summed.select("_path", "_block", (F.col("before") - F.col("_first") + 1).alias("_shift")),
        "line-offsets", {"rows": F.count(F.lit(1))})
    offsets = broadcast_if_small(offsets, max_broadcast_blocks, known_rows=m["rows"])
    numbered = df.join(offsets, ["_path", "_block"])
    cols = [(F.col("_scan") + F.col("_shift")).alias("line_id"), "value"]
    if with_file:
        cols.append("doc")
    return numbered.select(*cols)


def lines_from_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         keep: tuple[str, ...] = (),
                         stride: int = LINE_ID_STRIDE, wide: bool = False) -> DataFrame:
    """One row per line of a text column; ``line_id = id * stride + line_no``.

    Narrow transformation: no shuffle, splits stay where the scan put them.
    A document with ``stride`` lines or more would make ids collide; such a
    row fails the job (``raise_error``) rather than produce wrong ids. ``wide`` gives
    decimal(38) ids with a stride that no text can reach and no id can overflow; the joins
    take either type.
    """
    exploded = docs.select(F.col(id_col).alias("_doc"), *keep,
                           F.posexplode(split_lines(text_col)).alias("_pos", "value"))
    line_no = F.col("_pos") + 1
    if wide:
        wide_id = (F.col("_doc").cast("decimal(20,0)") * F.lit(WIDE_STRIDE).cast("decimal(14,0)")
                   + line_no.cast("decimal(20,0)"))
        return exploded.select(wide_id.cast("decimal(38,0)").alias("line_id"),
                               F.col("_doc").alias(id_col), line_no.alias("line_no"), *keep, "value")
    line_id = F.when(line_no < stride, F.col("_doc") * stride + line_no).otherwise(
        F.raise_error(F.lit(f"a document has {stride} lines or more; widen the line-id stride")))
    return exploded.select(
        line_id.cast("bigint").alias("line_id"),
        F.col("_doc").alias(id_col), line_no.alias("line_no"), *keep, "value")

