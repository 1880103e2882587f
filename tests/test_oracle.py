"""Every registered query against its DuckDB SQL on the sf0.001 tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from lexiflow.plans.catalog import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for f in os.listdir(sf_small):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM "
                        f"read_parquet('{os.path.join(sf_small, f)}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    return v


def _canon(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


def test_every_query_has_oracle():
    assert set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_small, duck, name):
    df = entry.queries()[name](spark, sf_small)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _canon(df.columns, got) == _canon(cols, res.fetchall())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_a", "doc_b", "similarity"]
    assert df.count() >= 0
