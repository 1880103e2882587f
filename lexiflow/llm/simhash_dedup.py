"""SimHash near-duplicate groups with pivot distance tables.

1. A 64-bit fingerprint per text: the bitwise majority of the XXH64 hashes of
   its word shingles.
2. Equal fingerprints collapse to one row, so a group of exact copies costs one row
   however large it is.
3. Candidates: two fingerprints at distance <= r agree in at least ``B - r`` of
   ``B`` bit blocks (pigeonhole), so each fingerprint is filed under every
   combination of ``B - r`` of its blocks. With r = 4 and six blocks that
   is 15 rows of 16 bytes per distinct fingerprint.
4. In each file ("cell") the Hamming distances of all members to a fixed
   set of reference fingerprints (pivots) are tabulated first. By the
   triangle inequality a pair whose coordinates differ by more than r in any
   pivot is discarded; survivors are verified with the exact bit distance.
   Pivot coordinates alone do not make a join key at r = 4 (a random pair agrees
   within 4 on one pivot more often than not), hence the block files of step 3.
5. A cell emits a spanning forest of its links, not the links: every link
   joins two members of one tree, so the components are exactly those of all
   links, and a dense cell of k fingerprints emits at most k - 1 edges.
6. A file with more than ``cell_rows`` members is cut into hash blocks, and
   every pair of blocks becomes a cell of its own, so no task ever holds more
   than about two blocks.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiflow.llm.common import (free_name, hot_limit, join_counted, popcount, text_or_empty,
                                 text_udf)
from lexiflow.llm.graph import connected_components
from lexiflow.operators.joins import broadcast_if_small
from lexiflow.session import materialize, materialize_measured

SHINGLE_WORDS = 4
MAX_BITS = 4
BLOCKS = 6
N_PIVOTS = 24
CELL_ROWS = 4096
HASH_SEED = 42
#: shingles are hashed in runs of this many, so a text of any length needs bounded memory
_RUN = 1 << 16


def fingerprint(text: str, width: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of one text; 0 for a text without words.

    bytes.lower() folds A-Z only and bytes.split() cuts at exactly
    space and 0x09-0x0D, the contract's two rules.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    starts = np.empty(n + 1, np.int64)
    starts[0] = 0
    np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1, out=starts[1:])
    k = min(width, n)
    total = n - k + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, total, _RUN):
        hi = min(total, lo + _RUN)
        a, b = starts[lo:hi].tolist(), (starts[lo + k:hi + k] - 1).tolist()
        h = np.array([digest(joined[i:j], HASH_SEED) for i, j in zip(a, b, strict=True)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > total, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprint_column(text_col: str = "text", width: int = SHINGLE_WORDS):
    """Column of signed 64-bit fingerprints (the unsigned value's bits)."""
    def batch(texts):
        return np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)

    return text_udf(batch, "long")(text_or_empty(text_col))


def _pivots(n: int = N_PIVOTS) -> np.ndarray:
    return np.random.default_rng(20240607).integers(0, 1 << 64, n, dtype=np.uint64)


def _block_masks(blocks: int, radius: int) -> list[int]:
    """Signed masks of every combination of ``blocks - radius`` bit blocks."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    masks = [sum(c) for c in combinations(parts, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def link_forest(fps: np.ndarray, table: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning forest (index pairs) of the links among distinct ``fps``.

    Breadth first: a popped member is compared with all members not yet
    reached; the pivot table discards, the bit distance decides. Reached members
    leave the pool, so a dense cell shrinks at once.
    """
    rest = np.arange(len(fps))
    out: list[tuple[int, int]] = []
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            near = rest[(np.abs(table[rest] - table[i]) <= radius).all(axis=1)]
            near = near[popcount(fps[near] ^ fps[i]) <= radius]
            if len(near):
                out.extend((i, int(j)) for j in near)
                queue.extend(near.tolist())
                rest = rest[~np.isin(rest, near, assume_unique=True)]
    return out


def _cell_edges(cells: np.ndarray, fps: np.ndarray, pivots: np.ndarray, radius: int):
    """Edges (index pairs) of rows sorted by cell."""
    n = len(cells)
    if n < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cuts = np.flatnonzero(cells[1:] != cells[:-1]) + 1
    starts = np.concatenate([[0], cuts])
    sizes = np.diff(np.concatenate([starts, [n]]))
    u = fps.view(np.uint64)
    member = np.repeat(sizes > 1, sizes)
    table = np.zeros((n, len(pivots)), np.int8)
    table[member] = popcount(u[member][:, None] ^ pivots[None, :]).astype(np.int8)
    a_out, b_out = [], []
    # short runs: row i against row i + k of the same cell, for all cells at once
    short = np.repeat((sizes > 1) & (sizes <= 16), sizes)
    i = np.flatnonzero(short)
    k = 1
    while len(i):
        i = i[i + k < n]
        i = i[cells[i] == cells[i + k]]
        j = i + k
        ok = (np.abs(table[i] - table[j]) <= radius).all(axis=1)
        x, y = i[ok], j[ok]
        ok = popcount(u[x] ^ u[y]) <= radius
        a_out.append(x[ok])
        b_out.append(y[ok])
        k += 1
    for s, m in zip(starts[sizes > 16], sizes[sizes > 16], strict=True):
        pairs = link_forest(u[s:s + m], table[s:s + m], radius)
        if pairs:
            p = np.array(pairs, np.int64) + s
            a_out.append(p[:, 0])
            b_out.append(p[:, 1])
    if not a_out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(a_out), np.concatenate(b_out)


def _edges_of_partition(radius: int, n_pivots: int):
    def run(batches):
        pivots = _pivots(n_pivots)
        kept_c = np.empty(0, np.int64)
        kept_f = np.empty(0, np.int64)

        def emit(c, f):
            a, b = _cell_edges(c, f, pivots, radius)
            return pa.RecordBatch.from_arrays([pa.array(f[a]), pa.array(f[b])], names=["a", "b"])

        for batch in batches:
            c = np.concatenate([kept_c, batch.column(0).to_numpy(zero_copy_only=False)])
            f = np.concatenate([kept_f, batch.column(1).to_numpy(zero_copy_only=False)])
            if not len(c):
                continue
            # the last cell may go on in the next batch
            last = int(np.searchsorted(c, c[-1], side="left"))
            kept_c, kept_f = c[last:], f[last:]
            yield emit(c[:last], f[:last])
        yield emit(kept_c, kept_f)

    return run


def fingerprint_links(fps: DataFrame, radius: int = MAX_BITS, blocks: int = BLOCKS,
                      n_pivots: int = N_PIVOTS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Edges ``(a, b)`` whose components equal those of all links among distinct ``fps(fp)``."""
    if not radius < blocks:
        raise ValueError("blocks must exceed the maximum bit distance")
    masks = _block_masks(blocks, radius)
    filed = fps.select("fp", F.explode(F.array(*[
        F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)
    ])).alias("file"))
    hot, seen = materialize_measured(
        filed.groupBy("file").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > cell_rows),
        "hot-files", {"n": F.count(F.lit(1))})
    if seen["n"] == 0:
        cells = filed.select(F.col("file").alias("cell"), "fp")
    else:
        parts = F.ceil(F.col("k") / F.lit(cell_rows)).cast("int")
        joined = (filed.join(broadcast_if_small(hot, known_rows=seen["n"]), "file", "left")
                  .withColumn("nb", F.coalesce(parts, F.lit(1)))
                  .withColumn("b", F.pmod(F.xxhash64("fp", F.lit("block")), F.col("nb")).cast("int"))
                  .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))))
        cells = joined.select(
            F.when(F.col("nb") == 1, F.col("file"))
            .otherwise(F.xxhash64("file", F.least("b", "o"), F.greatest("b", "o"))).alias("cell"),
            "fp")
    spread = cells.repartition("cell").sortWithinPartitions("cell")
    return spread.mapInArrow(_edges_of_partition(radius, n_pivots), "a long, b long").distinct()


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          width: int = SHINGLE_WORDS, radius: int = MAX_BITS,
                          cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per input row: id, ``fp`` (signed bits), ``component_id``.

    ``component_id`` is the smallest id reachable over links of at most
    ``radius`` differing bits, the row's own id included. A fingerprint or component with very many
    rows is joined by broadcast, the others by shuffle.

    Defined cases: a null or empty text has fingerprint 0 and links like any
    other; repeated rows come out as often as they went in; a row whose id is
    null takes part and gets the smallest known id of its component (null when it
    has none); an empty table gives an empty result; other columns, whatever
    their names, are not read.
    """
    rows, seen = materialize_measured(
        docs.select(F.col(id_col).alias("id"), fingerprint_column(text_col, width).alias("fp")),
        "simhash", {"n": F.count(F.lit(1))})
    most = hot_limit(seen["n"])
    fps = materialize(rows.groupBy("fp").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("copies")),
                      "simhash-distinct")
    edges = fingerprint_links(fps.select("fp"), radius, cell_rows=cell_rows)
    labels = connected_components(edges)
    linked = fps.join(labels.withColumnRenamed("node", "fp"), "fp").select("fp", "low", "label")
    lowest = linked.groupBy(F.col("label").alias("root")).agg(F.min("low").alias("component_id"),
                                                              F.count(F.lit(1)).alias("_k"))
    linked = join_counted(linked, lowest, "label", "root", most).select("fp", "component_id")
    per_fp = (fps.join(linked, "fp", "left")
              .select(F.col("fp").alias("print"), F.col("copies").alias("_k"),
                      F.coalesce("component_id", "low").alias("component_id")))
    per_fp = materialize(per_fp, "simhash-components")
    return join_counted(rows, per_fp, "fp", "print", most).select(
        F.col("id").alias(id_col), "fp", "component_id")


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       width: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its near-duplicate group.

    An id names one document: of several rows with one id the one whose text comes first in byte order
    stays (null first; equal texts: any). Rows with a null id cannot be named by a group and all stay. All
    columns are returned, whatever their names.
    """
    groups = near_duplicate_groups(docs, id_col, text_col, width, radius)
    keep_id, nth = free_name(docs, "_keep_id"), free_name(docs, "_nth")
    keep = (groups.where(F.col(id_col) == F.col("component_id"))
            .select(F.col(id_col).alias(keep_id)).distinct())
    first = Window.partitionBy(id_col).orderBy(F.col(text_col).asc_nulls_first())
    kept = (docs.where(F.col(id_col).isNotNull())
            .join(keep, F.col(id_col) == F.col(keep_id), "left_semi")
            .withColumn(nth, F.row_number().over(first)).where(F.col(nth) == 1).drop(nth))
    return kept.unionByName(docs.where(F.col(id_col).isNull()))
