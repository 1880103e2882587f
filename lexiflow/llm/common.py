"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: texts are handed to the vectorised kernels in slices of about this many characters
SLICE_CHARS = 1 << 20
#: a key with fewer rows than this is never hot; a broadcast of hot keys has at most HOT_KEYS rows
HOT_ROWS = 256
HOT_KEYS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, prolonged until no column of ``df`` has it (names are compared as Spark does, without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(col: str = "text") -> Column:
    """A null text counts as an empty one throughout the subpackage."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def finite_entries(vec: Column) -> Column:
    """Is the vector known, with every entry known and finite? (an empty one is)"""
    ok = vec.isNotNull() & F.forall(
        vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.coalesce(ok, F.lit(False))


def text_udf(fn, returns: str | T.DataType):
    """A batch UDF over one text column: ``fn(list of str) -> list or array``.

    ``fn`` may carry state loaded once per Python worker. Marked
    nondeterministic only so that Spark evaluates it once when a later filter
    reads its result; it is in fact a pure function of the text.
    """
    @F.pandas_udf(returns)
    def apply(texts: pd.Series) -> pd.Series:
        out: list = []
        for part in slices([t or "" for t in texts]):
            out.extend(fn(part))
        return pd.Series(out, dtype=object if isinstance(returns, T.DataType) else None)

    return apply.asNondeterministic()


def slices(texts: list[str], limit: int = SLICE_CHARS):
    """Consecutive slices of ``texts`` of about ``limit`` characters each (one text is never cut)."""
    part: list[str] = []
    size = 0
    for t in texts:
        if part and size + len(t) > limit:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def join_counted(rows: DataFrame, side: DataFrame, key: str, side_key: str, most: int) -> DataFrame:
    """Inner join of ``rows`` with ``side``, whose keys are distinct and whose ``_k`` counts a key's ``rows``.

    Keys with more than ``most`` rows go by broadcast and so never meet in one task; there are
    at most ``total / most`` of them, which is the caller's bound on the broadcast.
    The others are shuffled, at most ``most`` rows per key. Null keys match nothing.
    """
    on = F.col(key) == F.col(side_key)
    hot, cold = side.where(F.col("_k") > most), side.where(F.col("_k") <= most)
    direct = rows.join(F.broadcast(hot), on)
    dealt = rows.join(F.broadcast(hot.select(side_key)), on, "left_anti").join(cold, on)
    return direct.unionByName(dealt).drop("_k", side_key)


def hot_limit(total: int, most_keys: int = HOT_KEYS, least: int = HOT_ROWS) -> int:
    """Rows from which a key counts as hot, such that ``total`` rows have at most ``most_keys`` hot keys."""
    return max(least, -(-total // most_keys))


def give_back_memory() -> None:
    """Hand what a finished step has freed in this process back to the system.

    Arrow and the C library keep freed memory for later use; a driver that fits a model once would hold it for the rest
    of the job. Where the C library has no such call, nothing happens.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)
