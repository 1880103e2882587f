"""Join helpers: size-checked broadcast and a skew-safe pair generator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A broadcast side must hold at most this many rows (~10 MB of short keys).
DEFAULT_BROADCAST_ROWS = 200_000
# A broadcast key table (e.g. word -> count) must stay under this many bytes.
DEFAULT_KEY_BROADCAST_BYTES = 32 * 1024 * 1024
# A broadcast side of wide rows (token arrays) must stay under this many bytes.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
# Largest number of members of one group paired inside a single join cell.
DEFAULT_CELL_ROWS = 2_048


def broadcast_if_small(side: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       known_rows: int | None = None, known_bytes: int = 0,
                       max_bytes: int = DEFAULT_KEY_BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after counting the side (call on a materialized side).

    ``known_rows`` is a count already measured (e.g. observed while the side
    was written), which saves the counting job; ``known_bytes`` is the measured size of
    a side with strings (:func:`key_table_bytes`), whose rows alone bound nothing. Past either
    limit the side is returned unchanged and the planner shuffles (AQE may still
    convert the join from measured runtime statistics).
    """
    n = side.count() if known_rows is None else known_rows
    return F.broadcast(side) if n <= max_rows and known_bytes <= max_bytes else side


def key_table_bytes(rows: int, string_cols: int, chars: int) -> int:
    """Estimated in-memory bytes: 32 per row, 16 per string value, plus the characters."""
    return 32 * rows + 16 * rows * string_cols + chars


def _plain_pairs(members: DataFrame, group_cols: list[str], id_col: str,
                 carry: list[str]) -> DataFrame:
    """Self equi-join on the group with ``l.id < r.id`` (groups known to be small)."""
    left = members.select(*group_cols, F.col(id_col).alias(f"l_{id_col}"),
                          *[F.col(c).alias(f"l_{c}") for c in carry])
    right = members.select(*[F.col(g).alias(f"_r_{g}") for g in group_cols],
                           F.col(id_col).alias(f"r_{id_col}"),
                           *[F.col(c).alias(f"r_{c}") for c in carry])
    cond = [F.col(g) == F.col(f"_r_{g}") for g in group_cols]
    cond.append(F.col(f"l_{id_col}") < F.col(f"r_{id_col}"))
    joined = left.join(right, cond)
    return joined.select(*group_cols, f"l_{id_col}", f"r_{id_col}",
                         *[x for c in carry for x in (f"l_{c}", f"r_{c}")])


def pairs_within_groups(members: DataFrame, group_cols: list[str], id_col: str,
                        group_size_col: str | None, carry: list[str] | None = None,
                        cell_rows: int = DEFAULT_CELL_ROWS) -> DataFrame:
    """All unordered pairs (left.id < right.id) of members sharing a group.

    Skew-safe: a group of ``k`` members is cut into ``B = ceil(k / cell_rows)``
    hash buckets, and bucket pairs ``(i, j), i <= j`` become join cells, so no
    task pairs more than about ``cell_rows**2`` rows however large one group
    is. Each member is replicated to ``B`` cells (``B = 1`` for ordinary
    groups, i.e. a plain equi-join). ``group_size_col`` must hold ``k``.

    ``group_size_col=None`` declares every group small (a proven bound of at
    most ``cell_rows`` members): a plain self-join, no bucket columns.

    Returns columns ``<group_cols>``, ``l_<id>``, ``r_<id>`` and ``l_``/``r_``
    copies of ``carry``.
    """
    carry = carry or []
    if group_size_col is None:
        return _plain_pairs(members, group_cols, id_col, carry)
    n_buckets = F.greatest(F.lit(1), F.ceil(F.col(group_size_col) / F.lit(cell_rows))).cast("int")
    base = members.select(*group_cols, id_col, *carry, n_buckets.alias("_nb"))
    base = base.withColumn("_b", F.pmod(F.xxhash64(F.col(id_col)), F.col("_nb")).cast("int"))
    # left copy of a member in bucket b meets right buckets j >= b
    left = base.select(*group_cols, F.col("_b").alias("_cl"),
                       F.explode(F.sequence(F.col("_b"), F.col("_nb") - 1)).alias("_cr"),
                       F.col(id_col).alias(f"l_{id_col}"),
                       *[F.col(c).alias(f"l_{c}") for c in carry])
    # right copy of a member in bucket b meets left buckets i <= b
    right = base.select(*group_cols,
                        F.explode(F.sequence(F.lit(0), F.col("_b"))).alias("_cl"),
                        F.col("_b").alias("_cr"),
                        F.col(id_col).alias(f"r_{id_col}"),
                        *[F.col(c).alias(f"r_{c}") for c in carry])
    keys = [*group_cols, "_cl", "_cr"]
    joined = left.join(right, keys)
    # cells off the diagonal hold each pair once; the diagonal holds both orders
    ordered = F.least(F.col(f"l_{id_col}"), F.col(f"r_{id_col}"))
    keep = (F.col("_cl") != F.col("_cr")) | (F.col(f"l_{id_col}") < F.col(f"r_{id_col}"))
    out = joined.where(keep & (F.col(f"l_{id_col}") != F.col(f"r_{id_col}")))
    # orient every pair so that l_id < r_id
    swap = F.col(f"l_{id_col}") > F.col(f"r_{id_col}")

    def pick(a: str, b: str) -> F.Column:
        return F.when(swap, F.col(b)).otherwise(F.col(a))

    cols = [F.col(c) for c in group_cols]
    cols.append(ordered.alias(f"l_{id_col}"))
    cols.append(F.greatest(F.col(f"l_{id_col}"), F.col(f"r_{id_col}")).alias(f"r_{id_col}"))
    for c in carry:
        cols.append(pick(f"l_{c}", f"r_{c}").alias(f"l_{c}"))
        cols.append(pick(f"r_{c}", f"l_{c}").alias(f"r_{c}"))
    return out.select(*cols)


def pairs_across_groups(left: DataFrame, right: DataFrame, group_cols: list[str],
                        left_id: str, right_id: str, sized: bool,
                        cell_rows: int = DEFAULT_CELL_ROWS) -> DataFrame:
    """Equi-join of two sides on ``group_cols``, skew-safe.

    With ``sized``, both sides carry ``_kl`` and ``_kr``: the group's row
    counts on the left and on the right (0 for groups known to be small). A
    group is cut into ``ceil(kl / cell_rows) x ceil(kr / cell_rows)`` cells:
    a left row is hashed (by ``left_id``) into its left bucket and copied to
    every right bucket, a right row likewise, so each (left, right) pair meets
    in exactly one cell and no task handles more than about ``cell_rows**2``
    pairs. Without ``sized`` it is a plain equi-join. Column names of the two
    sides must not clash except for ``group_cols``.
    """
    if not sized:
        return left.join(right, group_cols)

    def buckets(col: str):
        return F.greatest(F.lit(1), F.ceil(F.col(col) / F.lit(cell_rows))).cast("int")

    l_ = left.select("*",
                     F.pmod(F.xxhash64(left_id), buckets("_kl")).cast("int").alias("_cl"),
                     F.explode(F.sequence(F.lit(0), buckets("_kr") - 1)).alias("_cr"))
    r_ = right.select("*",
                      F.explode(F.sequence(F.lit(0), buckets("_kl") - 1)).alias("_cl"),
                      F.pmod(F.xxhash64(right_id), buckets("_kr")).cast("int").alias("_cr"))
    l_ = l_.drop("_kl", "_kr")
    r_ = r_.drop("_kl", "_kr")
    return l_.join(r_, [*group_cols, "_cl", "_cr"]).drop("_cl", "_cr")
