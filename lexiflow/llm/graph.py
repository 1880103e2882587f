"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lexiflow.llm.common import HOT_ROWS, hot_limit, join_counted
from lexiflow.session import scratch_path


def connected_components(edges: DataFrame, max_rounds: int = 60, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(node, label)`` for every node of ``edges(a, b)``: label = smallest node of its component.

    Each round rewires every neighbour of a node to the smallest node it knows
    (large-star: larger neighbours, small-star: smaller ones); the number of
    rounds grows with the logarithm of the longest path. The edge table never
    grows beyond its first size. A round is two group-by minima with map-side
    combine and two equi-joins; the minima of hubs (nodes with more than ``hot_rows``
    edges, and more than a fixed share of all) go to the edges by broadcast, so no hub's edges
    meet in one task. Each round's edges are written to the shared checkpoint folder, so a lost
    executor costs one round at most and lineage stays short.

    Self loops and null ends carry no link and are dropped; an empty table
    gives an empty result. Raises if the rounds run out before the stars are
    stable, instead of returning a partial labelling.
    """
    current, state = _write(edges.select("a", "b").where("a <> b")
                            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        # every edge counts at both of its ends
        most = hot_limit(2 * state[0], least=hot_rows)
        nxt, new_state = _write(_small_star(_large_star(current, most), most))
        current, done, state = nxt, new_state == state, new_state
        if done:
            break
    else:
        raise RuntimeError(f"components not stable after {max_rounds} rounds")
    # in a star forest every edge is (node, smallest node of the component)
    roots = current.select(F.col("b").alias("node")).distinct()
    return (current.select(F.col("a").alias("node"), F.col("b").alias("label"))
            .unionByName(roots.select("node", F.col("node").alias("label"))))


def _write(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Write the distinct edges; returns them with (count, two order-free digests)."""
    spark = edges.sparkSession
    path = scratch_path(spark, "edges")
    obs = Observation(f"edges-{uuid.uuid4().hex[:8]}")
    (edges.distinct().observe(obs, F.count(F.lit(1)).alias("n"),
                              F.expr("bit_xor(xxhash64(a, b))").alias("x"),
                              F.expr("bit_xor(xxhash64(b, a, 1))").alias("y"))
     .write.parquet(path))
    got = obs.get
    return spark.read.parquet(path), (got.get("n") or 0, got.get("x") or 0, got.get("y") or 0)


def _minima(edges: DataFrame) -> DataFrame:
    return (edges.groupBy(F.col("a").alias("node"))
            .agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("_k")))


def _large_star(edges: DataFrame, most: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _minima(both).withColumn("m", F.least("node", "m"))
    return (join_counted(both.where("b > a"), low, "a", "node", most)
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b"))


def _small_star(edges: DataFrame, most: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = _minima(down)
    moved = (join_counted(down, low, "a", "node", most).where("b <> m")
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return moved.unionByName(low.select(F.col("node").alias("a"), F.col("m").alias("b"))) \
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
