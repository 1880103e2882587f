"""Merkle manifest, whitening and embedding near-duplicates against brute force."""

import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lexiflow.llm import embedding_dedup, merkle, whitening
from lexiflow.llm.oracle import ORACLE_SQL

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# ---- Merkle manifest

def sha(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text):
    return sha("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))


def plain_tree(leaves):
    """(root, proof of every leaf): runs of three, level by level."""
    nodes, above, proofs = leaves, list(range(len(leaves))), [[] for _ in leaves]
    while len(nodes) > 1:
        for leaf, at in enumerate(above):
            run = at // 3 * 3
            proofs[leaf].append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + 3])))
        nodes = [sha(nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
        above = [at // 3 for at in above]
    return nodes[0], proofs


def plain_audit(rows):
    """Rows are (doc_id, text, lang, source, n_chars)."""
    by = {}
    for d, text, lang, source, n in rows:
        leaf = plain_leaf(d, source, lang, n, text)
        bad = d is not None and zlib.crc32(str(d).encode()) % 2 == 0 and text is not None
        by.setdefault(source, []).append(
            (d is not None, d or 0, leaf, plain_leaf(d, source, lang, n, text.replace("\n", "")) if bad else leaf, d))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [plain_tree([r[2] for r in sorted(by[s], key=lambda r: r[:3])]) for s in names]
    root, tops = plain_tree([t[0] for t in trees])
    out = []
    for s, (sub, proofs), top in zip(names, trees, tops, strict=True):
        for r, proof in zip(sorted(by[s], key=lambda r: r[:3]), proofs, strict=True):
            node = r[3]
            for left, right in proof + top:
                node = sha([left, node, right])
            out.append((r[4], r[2], sub, root, sha(a + b for a, b in proof + top), node, node == root))
    return out


def key(rows):
    return sorted(map(repr, map(tuple, rows)))


@pytest.mark.parametrize("n,levels", [(1, 1), (3, 1), (28, 1), (82, 2), (400, 1), (400, 6)])
def test_manifest_equals_brute_force(spark, n, levels):
    rng = random.Random(n)
    names = [None, "", "hot", "hot", "hot", "b", "é", "z" * 300]
    rows = [(i, rng.choice(["one\ntwo", "", None, f"text {i}", "x\n" * 500]), "en", rng.choice(names), i % 7)
            for i in range(n)]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    assert key(merkle.audit(df, block_levels=levels).collect()) == key(plain_audit(rows))


def test_manifest_edge_rows(spark):
    rows = [(None, None, None, None, None), (None, "a\nb", None, "s", 3), (7, "same\n", "en", "s", 5),
            (7, "same\n", "en", "s", 5), (7, "other", "en", "s", 5), (-3, "\n" * 3, None, "s", None),
            (9, "long " * 400_000 + "\n", "de", "t", 2_000_001)]
    rows += [(100 + i, "copy\n", "en", "c", 5) for i in range(300)] + [(500, "twin", "en", "c", 4)] * 40
    df = spark.createDataFrame(rows, DOCS)
    # columns named like the operator's own
    named = df.selectExpr("*", *[f"1 AS {c}" for c in ("id", "grp", "digest", "pos", "tree", "n", "block", "leaf",
                                                       "lefts", "_scan", "_part", "root", "tampered")])
    want = key(plain_audit(rows))
    assert key(merkle.audit(named, block_levels=2).collect()) == want
    assert merkle.audit(df.limit(0)).count() == 0
    assert len(set(map(repr, merkle.audit(df).select("root").collect()))) == 1


def test_witnesses_fold_to_the_root(spark):
    df = spark.range(200).select(F.col("id").alias("k"), F.pmod("id", F.lit(3)).cast("string").alias("g"))
    got = merkle.manifest(df, ("k",), "k", "g", {"mark": F.col("k") * 2}, block_levels=2)
    assert got.columns == ["k", "g", "leaf", "subroot", "root", "lefts", "rights", "mark"]
    bad = got.where(merkle.fold(F.col("leaf"), F.col("lefts"), F.col("rights")) != F.col("root"))
    assert bad.count() == 0 and got.where("mark <> 2 * k").count() == 0
    wrong = got.where(merkle.fold(F.sha2("leaf", 256), F.col("lefts"), F.col("rights")) == F.col("root"))
    assert wrong.count() == 0


# ---- whitening

def check_whitening(got, vectors, dim):
    """Rows of the operator against an eigendecomposition; ``vectors`` has (id, list) of the fit list."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in vectors]
    n = len(x)
    sums = [sum(col) for col in zip(*x, strict=True)]
    a = np.array([[(n * c - s) / n for c, s in zip(r, sums, strict=True)] for r in x])
    values, basis = np.linalg.eigh(a.T @ a / n)
    values, basis = values[::-1], basis[:, ::-1]
    k = min(8, int((values > 1e-10 * values.sum()).sum()))
    assert len(got) == n * k
    per = {}
    for r in got:
        per.setdefault(r.component, {}).setdefault(r.vec_id, []).append(r)
    assert sorted(per) == list(range(1, k + 1))
    dev = {}
    for (i, _), r in zip(vectors, x, strict=True):
        dev.setdefault(i, []).append(sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True)))
    for j in range(k):
        want = {}
        for (i, _), y in zip(vectors, a @ basis[:, j] / np.sqrt(values[j]), strict=True):
            want.setdefault(i, []).append(y)
        rows = per[j + 1]
        assert rows.keys() == want.keys()
        first = max(want, key=lambda i: abs(want[i][0]))
        biggest = max(want[first], key=abs)
        sign = np.sign(biggest * max((r.whitened for r in rows[first]), key=abs))
        for i, rs in rows.items():
            assert np.allclose(sorted(r.whitened * sign for r in rs), sorted(want[i]), rtol=0, atol=1e-8)
            assert sorted(r.deviation for r in rs) == sorted(dev[i])
            assert all(r.n == n and abs(r.explained * values.sum() / values[j] - 1) < 1e-9 for r in rs)
            assert all(r.identity_error < 1e-8 for r in rs)


def test_whitening_of_the_table(spark, sf_small):
    got = entry.queries()["op12_embedding_whitening"](spark, sf_small).collect()
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()]
    check_whitening(got, vectors, 64)


@pytest.mark.parametrize("n,dim,rank", [(40, 5, 5), (300, 12, 12), (60, 10, 4), (30, 40, 29)])
def test_whitening_equals_eigenvectors(spark, n, dim, rank):
    rng = np.random.default_rng(n)
    base = rng.standard_normal((n, rank)) * np.arange(1, rank + 1) ** 1.5
    # whole multiples of 1/1024 keep a low rank low
    v = (np.round(base * 50) @ np.round(rng.standard_normal((rank, dim)) * 3)) / 1024
    vectors = [(i % 7 if i < 20 else i, r) for i, r in enumerate(v.tolist())]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3)
    check_whitening(whitening.whiten(df).collect(), vectors, dim)


def test_whitening_of_equal_eigenvalues(spark):
    # every direction has the same variance: restarts must find a whole basis
    vectors = [(i * 2 + s, [(1.0 if s else -1.0) if j == i else 0.0 for j in range(12)])
               for i in range(12) for s in (0, 1)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = whitening.whiten(df).collect()
    assert len(got) == 24 * 8 and max(r.identity_error for r in got) < 1e-9
    assert all(abs(r.explained - 1 / 12) < 1e-9 for r in got)


def test_long_vectors_may_stop_early(spark):
    rng = np.random.default_rng(4)
    v = rng.standard_normal((200, 30)) * (2.0 ** -np.arange(30))
    vectors = list(enumerate(v.tolist()))
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = {(r.vec_id, r.component): r for r in whitening.whiten(df, full_length=10).collect()}
    want = {(r.vec_id, r.component): r for r in whitening.whiten(df).collect()}
    assert got.keys() == want.keys()
    assert all(abs(abs(got[i].whitened) - abs(want[i].whitened)) < 1e-6 for i in want)


def test_whitening_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(9)
    good = [(i, rng.standard_normal(3).tolist()) for i in range(30)]
    good += [(None, [0.0, 0.0, 0.0]), (5, [0.5, -0.25, 1.0]), (5, [0.5, -0.25, 1.0])]
    bad = [(50, None), (51, [1.0, None, 2.0]), (52, [nan, 0.0, 0.0]), (53, [0.0, inf, 0.0]), (54, []), (55, [1.0])]
    kind = "vec_id long, embedding array<double>"
    df = spark.createDataFrame(good + bad, kind).selectExpr(
        "*", "1 AS id", "2 AS x", "3 AS component", "4 AS n", "5 AS whitened")
    check_whitening(whitening.whiten(df).collect(), good, 3)
    for few in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], bad):
        assert whitening.whiten(spark.createDataFrame(few, kind)).count() == 0
    # beyond the range of a long: held, and no wrong deviation
    huge = whitening.whiten(spark.createDataFrame([(1, [1e300]), (2, [-1e300]), (3, [0.0])], kind)).collect()
    assert len(huge) == 3 and {r.deviation for r in huge if r.vec_id != 3} == {None}


# ---- embedding near-duplicates

def plain_dedup(rows, threshold=0.95):
    """Rows are (id, list or None); by pairs, with a plain flood fill."""
    dim = max((len(v) for _, v in rows if v), default=0)
    ok = [v is not None and all(c is not None and math.isfinite(c) for c in v) and any(v) for _, v in rows]
    x = np.array([np.pad(np.array(v, float) / max(map(abs, v)), (0, dim - len(v))) if good else np.zeros(dim)
                  for (_, v), good in zip(rows, ok, strict=True)]).reshape(len(rows), dim)
    norm = np.sqrt((x * x).sum(1))
    cos = (x @ x.T) / np.where(norm > 0, norm, 1)[:, None] / np.where(norm > 0, norm, 1)[None, :]
    link = (cos >= threshold) & np.outer(np.array(ok, bool), np.array(ok, bool)) & ~np.eye(len(rows), dtype=bool)
    out, part = [], {}
    for i in range(len(rows)):
        if i in part:
            continue
        seen, todo = {i}, [i]
        while todo:
            for j in np.flatnonzero(link[todo.pop()]).tolist():
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        part.update(dict.fromkeys(seen, low))
    for i, (vec_id, _) in enumerate(rows):
        out.append((vec_id, int(link[i].sum()), part[i], vec_id == part[i]))
    return out


def clusters(n, dim, seed, spread):
    """Random vectors, chains and balls of near copies, exact copies, scaled copies."""
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((n, dim))
    hot = rng.standard_normal(dim)
    v[:n // 3] = hot + spread * rng.standard_normal((n // 3, dim))
    for i in range(n // 3, n // 3 + 40):  # a chain: neighbours link, its ends do not
        v[i] = v[i - 1] + spread * 1.5 * rng.standard_normal(dim)
    v[n // 2:n // 2 + 30] = v[0]
    v[n // 2 + 30:n // 2 + 40] = 3 * v[5]
    return [(int(i), r) for i, r in zip(rng.permutation(n) + 10, v.tolist(), strict=True)]


@pytest.mark.parametrize("n,dim,tile", [(300, 5, 16), (500, 40, 64), (500, 24, None), (240, 1, 20), (300, 2, 7)])
def test_dedup_equals_brute_force(spark, n, dim, tile):
    for spread in (0.05, 0.25):
        rows = clusters(n, dim, n + dim, spread)
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
        got = embedding_dedup.near_duplicates(df, tile_rows=tile).collect()
        assert key(got) == key(plain_dedup(rows))


def test_links_by_steps_equal_plain_products():
    rng = np.random.default_rng(6)
    for dim in (3, 16, 33, 100):
        x = rng.standard_normal((700, dim)) + 2.0 * (rng.random((700, 1)) < 0.3)
        x /= np.linalg.norm(x, axis=1)[:, None]
        axes = embedding_dedup.principal_axes(x[:200])
        for t in (0.3, 0.8, 0.95):
            for a, b in ((x, x), (x[:300], x[300:])):
                got = set()
                for i, j in embedding_dedup.linked_pairs(a, b, a @ axes, b @ axes, t, a is b, lead=8, strip=64):
                    got |= set(zip(i.tolist(), j.tolist(), strict=True))
                want = np.argwhere(a @ b.T >= t)
                assert got == {(i, j) for i, j in want.tolist() if a is not b or i < j}


def test_dedup_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(9, [1.0, 2.0]), (3, [2.0, 4.0]), (4, [1.0, 2.0]), (4, [1.0, 2.0]), (None, [1.0, 2.01]), (None, [-5.0, 0.0]),
            (None, [-5.0, 0.0]), (20, None), (21, []), (22, [0.0, 0.0]), (23, [nan, 1.0]), (24, [inf, 1.0]),
            (25, [None, 1.0]), (26, [3.0]), (27, [3.0, 0.1]), (28, [1e300, 1e300]), (29, [1e-300, 1e-300]),
            (20, None), (30, [0.0, -1.0]), (30, [1.0, -1.0])]
    kind = "vec_id long, embedding array<double>"
    df = spark.createDataFrame(rows, kind).selectExpr(
        "*", *[f"1 AS {c}" for c in ("id", "vec", "mark", "node", "copies", "tile", "low", "label", "n_links", "kept")])
    got = embedding_dedup.near_duplicates(df)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert key(got.collect()) == key(plain_dedup(rows))
    for few in ([], [(1, None)], [(1, [1.0])]):
        assert key(embedding_dedup.near_duplicates(spark.createDataFrame(few, kind)).collect()) == key(plain_dedup(few))


def test_dedup_sql_finds_the_same(spark, tmp_path):
    rows = clusters(150, 6, 2, 0.2) + [(5000, None), (5001, [0.0] * 6), (5002, [float("nan")] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df.coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = entry.queries()["op13_embedding_dedup"](spark, str(tmp_path))
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
        want = db.execute(ORACLE_SQL["op13_embedding_dedup"]).fetchall()
    assert key(got.select("vec_id", "n_links", "component_id", "kept").collect()) == key(want)
    assert max(r[1] for r in want) > 30
