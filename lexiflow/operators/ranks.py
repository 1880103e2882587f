"""Dense ranks over any number of rows: range partitions plus two-level prefix sums.

A window without a partition key would bring every row to one task. Here rows are dealt out by
range, sorted where they lie and numbered by the scan; only one row per partition (and group)
is summed up, in windows of at most ``WIDTH`` rows and as many levels as the partitions need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiflow.operators.joins import broadcast_if_small, key_table_bytes
from lexiflow.session import materialize_measured

#: rows of one window of a prefix sum
WIDTH = 256
#: a scan id is ``partition << SCAN_BITS | row``
SCAN_BITS = 33


def same_keys(keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of ``keys`` with the columns of the other side named ``prefix + key``."""
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(prefix + k))
    return on


def prefix_sums(counts: DataFrame, key: str, value: str, largest: int,
                within: Sequence[str] = (), width: int = WIDTH) -> DataFrame:
    """``counts`` plus ``before``: the sum of ``value`` over the smaller keys of the same group.

    ``key`` is an integer from 0 to ``largest``, at most one row per group and key. Keys are
    cut into ranges of ``width``: sums inside a range come from a window over that range, sums of the
    ranges before it from the same function over one row per range.
    """
    ranged = counts.withColumn("_range", F.expr(f"{key} div {width}"))
    inside = (Window.partitionBy(*within, "_range").orderBy(key)
              .rowsBetween(Window.unboundedPreceding, -1))
    summed = ranged.withColumn("before", F.coalesce(F.sum(value).over(inside), F.lit(0)).cast("long"))
    if largest < width:
        return summed.drop("_range")
    totals = ranged.groupBy(*within, F.col("_range").alias("_key")).agg(F.sum(value).alias("_total"))
    outer = prefix_sums(totals, "_key", "_total", largest // width, within, width)
    outer = outer.select(*[F.col(c).alias(f"_outer_{c}") for c in within],
                         F.col("_key").alias("_outer__range"), F.col("before").alias("_earlier"))
    return (summed.join(outer, same_keys([*within, "_range"], "_outer_"))
            .withColumn("before", F.col("before") + F.col("_earlier"))
            .drop("_range", "_earlier", *[f"_outer_{c}" for c in [*within, "_range"]]))


def sorted_runs(rows: DataFrame, order_by: Sequence[str], within: Sequence[str] = (),
                name: str = "sorted", partitions: int | None = None,
                width: int = WIDTH) -> tuple[DataFrame, DataFrame, dict]:
    """(numbered, runs, stats): ``rows`` written once in the order of ``within`` and ``order_by``.

    ``numbered`` adds ``_run_scan``, consecutive inside a partition. ``runs`` has one row per
    group and partition that holds rows of it: ``_run_part``, ``_run_first`` (its first ``_run_scan``),
    ``_run_rows`` and ``_run_before`` (rows of the group in earlier partitions); at most one row per
    partition and group. The order is ascending, nulls first; equal rows are split over partitions
    like others, since their place in the input is the last sort key. ``stats`` has the row count
    ``n`` and the largest partition number ``part``.
    """
    tied = rows.withColumn("_run_tie", F.monotonically_increasing_id())
    keys = [*within, *order_by, "_run_tie"]
    dealt = tied.repartitionByRange(partitions, *keys) if partitions else tied.repartitionByRange(*keys)
    scanned = (dealt.sortWithinPartitions(*keys).drop("_run_tie")
               .withColumn("_run_scan", F.monotonically_increasing_id()))
    numbered, stats = materialize_measured(scanned, name, {
        "n": F.count(F.lit(1)), "part": F.shiftright(F.max("_run_scan"), SCAN_BITS)})
    runs = (numbered.groupBy(*within, F.shiftright("_run_scan", SCAN_BITS).cast("int").alias("_run_part"))
            .agg(F.min("_run_scan").alias("_run_first"), F.count(F.lit(1)).alias("_run_rows")))
    summed = prefix_sums(runs, "_run_part", "_run_rows", stats["part"], within, width)
    return numbered, summed.withColumnRenamed("before", "_run_before"), stats


def attach_runs(numbered: DataFrame, runs: DataFrame, alias: str,
                within: Sequence[str] = (), carry: Sequence[str] = ()) -> DataFrame:
    """``numbered`` with ``alias``, a row's rank in its group, and the columns ``carry`` of ``runs``.

    The runs are written once and broadcast below the checked size; beyond it the join shuffles on
    group and partition, at most one partition's rows per key.
    """
    keys = [*within, "_run_part"]
    side, m = materialize_measured(
        runs.select(*[F.col(k).alias(f"_run_r_{k}") for k in keys], "_run_first", "_run_before", *carry), "runs",
        {"rows": F.count(F.lit(1)), "chars": F.sum(_chars(within, carry))})
    side = broadcast_if_small(side, known_rows=m["rows"],
                              known_bytes=key_table_bytes(m["rows"], len(within) + len(carry), m["chars"]))
    return (numbered.withColumn("_run_part", F.shiftright("_run_scan", SCAN_BITS).cast("int"))
            .join(side, same_keys(keys, "_run_r_"))
            .withColumn(alias, F.col("_run_scan") - F.col("_run_first") + F.col("_run_before"))
            .drop("_run_scan", "_run_part", "_run_first", "_run_before", *[f"_run_r_{k}" for k in keys]))


def _chars(within: Sequence[str], carry: Sequence[str]) -> Column:
    """Bytes of a run's key and carried columns, as text."""
    total = F.lit(0).cast("long")
    for c in [*[f"_run_r_{k}" for k in within], *carry]:
        total = total + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    return total


def dense_ranks(rows: DataFrame, order_by: Sequence[str], within: Sequence[str] = (),
                alias: str = "rank", name: str = "ranked", partitions: int | None = None,
                width: int = WIDTH) -> DataFrame:
    """``rows`` plus ``alias``: 0, 1, 2, ... in the order of ``order_by`` inside each group ``within``.

    Ascending, nulls first; rows equal in all these columns get different ranks, in the order of
    the input. No task holds more than one range of rows, however large a group is.
    """
    numbered, runs, _ = sorted_runs(rows, order_by, within, name, partitions, width)
    return attach_runs(numbered, runs, alias, within)
