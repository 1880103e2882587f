"""Delimited text sinks (K1-K9): ``key<sep>value`` lines, like the reference's outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The key/value separators of the reference's output files.
TAB = "\t"
COMMA = ","
ARROW = " => "


def to_lines(df: DataFrame, key: str | Column, value: str | Column, sep: str = TAB) -> DataFrame:
    """One ``value`` string column: key, separator, value."""
    k = F.col(key) if isinstance(key, str) else key
    v = F.col(value) if isinstance(value, str) else value
    return df.select(F.concat(k.cast("string"), F.lit(sep), v.cast("string")).alias("value"),
                     k.alias("_key"))


def write_delimited(df: DataFrame, path: str, key: str | Column, value: str | Column,
                    sep: str = TAB, n_files: int | None = None, mode: str = "errorifexists",
                    sort: bool = True, total_order: bool = False) -> None:
    """Write ``key<sep>value`` text lines.

    ``n_files`` sets the number of output files by hash-partitioning on the
    key (every key in exactly one file, K7); ``sort`` orders lines by key
    inside each file (K8); ``mode`` is "errorifexists" (K5) or "overwrite" (K4).
    ``total_order`` deals keys out by range instead, so the files in name order are
    one sorted sequence (O2, O3), still with every key in exactly one file.
    For one merged file (K9) pass ``n_files=1`` — only for small results.
    """
    lines = to_lines(df, key, value, sep)
    if total_order:
        lines = (lines.repartitionByRange("_key") if n_files is None
                 else lines.repartitionByRange(n_files, "_key"))
    elif n_files is not None:
        lines = lines.repartition(n_files, "_key")
    if sort:
        lines = lines.sortWithinPartitions("_key")
    lines.select("value").write.mode(mode).text(path)


def write_scalar(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a one-row, one-column result as a single one-line text file (K6)."""
    col = df.columns[0]
    df.select(F.col(col).cast("string").alias("value")).coalesce(1).write.mode(mode).text(path)
