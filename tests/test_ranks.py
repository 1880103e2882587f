"""Dense ranks and prefix sums against plain sorting."""

import random

import pytest
from pyspark.sql import functions as F

from lexiflow.operators.ranks import dense_ranks, prefix_sums


@pytest.mark.parametrize("width", [2, 3, 256])
def test_prefix_sums_over_levels(spark, width):
    rng = random.Random(3)
    rows = [(g, k, rng.randrange(9)) for g in (None, "a", "b") for k in rng.sample(range(40), 25)]
    got = prefix_sums(spark.createDataFrame(rows, "g string, k int, v long"), "k", "v", 39, ["g"], width)
    assert {(r.g, r.k): r.before for r in got.collect()} == {
        (g, k): sum(v2 for g2, k2, v2 in rows if g2 == g and k2 < k) for g, k, _ in rows}
    assert got.columns == ["g", "k", "v", "before"]


@pytest.mark.parametrize("partitions,width", [(1, 256), (7, 2), (None, 256)])
def test_ranks_within_groups(spark, partitions, width):
    rng = random.Random(5)
    rows = [(rng.choice([None, "hot", "hot", "hot", "x", "é"]), rng.choice([None, *range(30)]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, k int, v int").repartition(5)
    got = dense_ranks(df, ["k", "v"], ["g"], alias="pos", partitions=partitions, width=width).collect()
    assert len(got) == len(rows)
    low = float("-inf")
    for g in {r[0] for r in rows}:
        want = sorted((low if k is None else k, v) for g2, k, v in rows if g2 == g)
        assert [(low if r.k is None else r.k, r.v) for r in sorted((r for r in got if r.g == g), key=lambda r: r.pos)] == want
        assert sorted(r.pos for r in got if r.g == g) == list(range(len(want)))


def test_ranks_of_all_rows_and_of_none(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = dense_ranks(df, ["k"], partitions=9, width=2)
    assert got.where("rank <> k").count() == 0 and got.count() == 1000
    assert dense_ranks(df.limit(0), ["k"]).count() == 0
    equal = dense_ranks(df.select(F.lit(1).alias("k")), ["k"], partitions=4)
    assert {r["rank"] for r in equal.collect()} == set(range(1000))
    plan = got._jdf.queryExecution().toString()
    assert "Window [" not in plan  # sums were written before; no window over the rows
