"""Approximate nearest neighbours: hierarchical k-means tree, best-bin-first search.

1. A tree of k-means splits is fitted on a bounded sample; its size is bounded by the
   sample's, so it can be shipped to every task.
2. Every row descends to the leaf of its nearest centroids.
3. A query walks the tree through a priority queue: the nearest unopened node is
   opened next, so leaves come out nearest first.
4. How many leaves a query visits is calibrated: for a bounded set of calibration queries the true
   neighbours are found by brute force over all rows, and the visits are widened
   until the wanted share of them lies in visited leaves. Every query also goes on until its
   leaves hold enough rows.
5. Neighbouring leaves share a shelf of about ``chunk`` rows, and rows and visiting queries meet
   per shelf, where a query is scored against the rows of its own leaves. A leaf with more rows is a
   shelf of its own, cut into chunks; a shelf with many visitors is cut into blocks of queries. Each
   (chunk, block) is scored in one task with exact double-precision distances, and keeps the
   best k of each query. The best k over all are then taken per query.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiflow.session import materialize

K = 10
SAMPLE = 20_000
BRANCHING = 8
LEAF_SAMPLE = 40
CALIBRATION_QUERIES = 100
#: wanted share of true neighbours in visited leaves on the calibration queries
TARGET_RECALL = 0.98
CHUNK = 4096
QUERY_BLOCK = 1024
SEED = 11


@dataclass
class Tree:
    """Nodes in one array; node 0 is the root. A node's children are ``first .. first + n - 1``."""

    centre: np.ndarray
    first: np.ndarray
    n_children: np.ndarray

    def descend(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row of ``x``."""
        node = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(self.n_children[node] > 0)
            if not len(inner):
                return node
            for p in np.unique(node[inner]):
                at = inner[node[inner] == p]
                kids = self.first[p] + np.arange(self.n_children[p])
                node[at] = kids[_sq_dists(x[at], self.centre[kids]).argmin(axis=1)]

    def leaves_in_order(self) -> list[int]:
        """Leaves depth first, so that neighbours in the list are neighbours in the tree."""
        out, todo = [], [0]
        while todo:
            p = todo.pop()
            n = int(self.n_children[p])
            if n:
                todo.extend(range(int(self.first[p]) + n - 1, int(self.first[p]) - 1, -1))
            else:
                out.append(p)
        return out

    def visit(self, q: np.ndarray):
        """Leaves best-bin-first, with their priority queue distances."""
        queue = [(0.0, 0)]
        while queue:
            d, p = heapq.heappop(queue)
            n = int(self.n_children[p])
            if not n:
                yield p
                continue
            kids = range(int(self.first[p]), int(self.first[p]) + n)
            diff = self.centre[kids.start:kids.stop] - q
            for kid, dist in zip(kids, np.einsum("ij,ij->i", diff, diff).tolist(), strict=True):
                heapq.heappush(queue, (dist, kid))


def _sq_dists(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :]


def _kmeans(x: np.ndarray, k: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """Centres (at most k, all used) and assignment; k-means++ seeds, ten Lloyd steps."""
    centre = [x[rng.integers(len(x))]]
    near = np.full(len(x), np.inf)
    while len(centre) < k:
        near = np.minimum(near, ((x - centre[-1]) ** 2).sum(1))
        if near.max() <= 0:
            break
        centre.append(x[rng.choice(len(x), p=near / near.sum())])
    c = np.array(centre)
    for _ in range(10):
        a = _sq_dists(x, c).argmin(1)
        used = np.unique(a)
        c = np.array([x[a == j].mean(0) for j in used])
    return c, _sq_dists(x, c).argmin(1)


def fit_tree(sample: np.ndarray, branching: int = BRANCHING, leaf: int = LEAF_SAMPLE,
             seed: int = SEED) -> Tree:
    """Split breadth first until a node has at most ``leaf`` sample rows or only equal ones."""
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    centre, first, n_children = [sample.mean(0) if len(sample) else np.zeros(dim)], [0], [0]
    todo = [(0, np.arange(len(sample)))]
    while todo:
        node, rows = todo.pop(0)
        if len(rows) <= leaf or (sample[rows] == sample[rows[0]]).all():
            continue
        c, a = _kmeans(sample[rows], branching, rng)
        groups = [rows[a == j] for j in range(len(c))]
        if sum(len(g) > 0 for g in groups) < 2:
            continue
        first[node], n_children[node] = len(centre), len(c)
        for j, g in enumerate(groups):
            centre.append(c[j])
            first.append(0)
            n_children.append(0)
            todo.append((len(centre) - 1, g))
    return Tree(np.array(centre, np.float64), np.array(first), np.array(n_children))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64, copy=False)


def valid_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec), one row per id, of rows that take part: known id, all components known and finite,
    not all zero."""
    v = F.col("vec")
    ok = (F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
          & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
          & F.exists(v, lambda c: c != 0))
    return (rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
            .where(F.coalesce(ok, F.lit(False)))
            .groupBy("id").agg(F.min("vec").alias("vec")))


def _best(ids: np.ndarray, x: np.ndarray, qid: int, q: np.ndarray, k: int):
    """(distance, id) of the k rows nearest to q, its own id left out; ties to the smaller id."""
    diff = x - q
    d = np.sqrt(np.einsum("ij,ij->i", diff, diff))
    at = np.flatnonzero(ids != qid)
    if len(at) > k:
        # keep every row that ties with the k-th
        at = at[d[at] <= np.partition(d[at], k - 1)[k - 1]]
    at = at[np.lexsort((ids[at], d[at]))][:k]
    return d[at], ids[at]


def _top(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _brute(queries: list[tuple[int, np.ndarray]], dim: int, k: int):
    """Best k of each query among the rows of one batch, with the rows' leaves."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            leaf = batch.column(2).to_numpy(zero_copy_only=False)
            x = _matrix(batch.column(1), dim)
            place = {}
            for i, v in enumerate(ids.tolist()):
                place.setdefault(v, i)
            out = [(qid, int(v), float(d), int(leaf[place[int(v)]])) for qid, q in queries
                   for d, v in zip(*_best(ids, x, qid, q, k), strict=True)]
            cols = list(zip(*out, strict=True)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.int64()),
                                                strict=True)],
                names=["query_id", "vec_id", "score", "leaf"])

    return run


def calibrate(indexed: DataFrame, tree: Tree, queries: list[tuple[int, np.ndarray]], k: int,
              target: float) -> int:
    """Leaf visits after which ``target`` of the true neighbours of ``queries`` have been met."""
    dim = tree.centre.shape[1]
    truth = _top(indexed.mapInArrow(_brute(queries, dim, k),
                                    "query_id long, vec_id long, score double, leaf long"), k).collect()
    by_query: dict[int, list[int]] = {}
    for r in truth:
        by_query.setdefault(r.query_id, []).append(r.leaf)
    places = []
    for qid, q in queries:
        if qid in by_query:
            order = {leaf: i for i, leaf in enumerate(tree.visit(q), 1)}
            places += [order[leaf] for leaf in by_query[qid]]
    if not places:
        return 1
    return int(np.sort(places)[max(0, int(np.ceil(target * len(places))) - 1)])


def shelves(order: list[int], held: dict[int, int], chunk: int) -> dict[int, int]:
    """Shelf of every leaf that holds rows: runs of leaves in tree order of at most ``chunk`` rows."""
    out: dict[int, int] = {}
    shelf, room = -1, 0
    for leaf in order:
        n = held.get(leaf, 0)
        if n:
            if shelf < 0 or n > room:
                shelf, room = shelf + 1, chunk
            out[leaf] = shelf
            room -= n
    return out


def _score_cell(dim: int, k: int):
    def run(cell: pa.Table) -> pa.Table:
        is_query = cell.column("is_query").to_numpy()
        ids = cell.column("id").to_numpy()
        x = _matrix(cell.column("vec"), dim)
        of = cell.column("leaves").combine_chunks()
        first = of.offsets.to_numpy()
        leaves = of.values.to_numpy()
        rows, queries = np.flatnonzero(~is_query), np.flatnonzero(is_query)
        row_ids, row_x, row_leaf = ids[rows], x[rows], leaves[first[rows]]
        d_out, v_out, n_out = [np.empty(0)], [np.empty(0, np.int64)], []
        for i in queries:
            at = np.isin(row_leaf, leaves[first[i]:first[i + 1]])
            d, v = _best(row_ids[at], row_x[at], ids[i], x[i], k)
            d_out.append(d)
            v_out.append(v)
            n_out.append(len(d))
        return pa.table({"query_id": pa.array(np.repeat(ids[queries], n_out).astype(np.int64)),
                         "vec_id": pa.array(np.concatenate(v_out).astype(np.int64)),
                         "score": pa.array(np.concatenate(d_out))})

    return run


def search(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding",
           k: int = K, sample: int = SAMPLE, target: float = TARGET_RECALL,
           chunk: int = CHUNK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of every query row, ties to the smaller id.

    ``is_query`` is a condition on the column ``id``. Candidates are all rows but the query's own
    id. With fewer than k candidates all are returned.

    Defined cases: rows with a null id, a null or empty vector, a null or non-finite component or
    only zeros take no part; of the rest, those whose length is not the commonest one (ties: the shortest)
    neither; of several rows with one id the smallest vector (in array order) takes part; an empty table
    gives an empty result; other columns are not read.
    """
    spark = rows.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    valid = valid_vectors(rows, id_col, vec_col)
    lengths = (valid.groupBy(F.size("vec").alias("dim")).count()
               .orderBy(F.desc("count"), "dim").limit(1).collect())
    if not lengths:
        return spark.createDataFrame([], schema)
    dim, total = lengths[0]["dim"], lengths[0]["count"]
    valid = valid.where(F.size("vec") == dim)
    unit = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1_000_000)) / F.lit(1e6)
    drawn = valid.where(unit < F.lit(min(1.0, sample / total))).toPandas().sort_values("id", kind="stable")
    if not len(drawn):
        drawn = valid.limit(sample).toPandas().sort_values("id", kind="stable")
    points = np.array(drawn["vec"].tolist(), np.float64)
    tree = fit_tree(points)

    def to_leaf(batches):
        for b in batches:
            leaf = tree.descend(_matrix(b.column(1), dim))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(leaf)],
                                             names=["id", "vec", "leaf"])

    indexed = materialize(valid.mapInArrow(to_leaf, "id long, vec array<double>, leaf long"), "ann-index")
    step = max(1, len(drawn) // CALIBRATION_QUERIES)
    probes = [(int(i), np.array(v, np.float64)) for i, v in
              zip(drawn["id"][::step][:CALIBRATION_QUERIES], drawn["vec"][::step][:CALIBRATION_QUERIES],
                  strict=True)]
    visits = calibrate(indexed, tree, probes, k, target)
    # one number per leaf: the tree's size bounds it
    held = {r.leaf: r["count"] for r in indexed.groupBy("leaf").count().collect()}

    shelf_of = shelves(tree.leaves_in_order(), held, chunk)

    def to_visits(batches):
        for b in batches:
            at, shelf, leaves = [], [], []
            for i, q in enumerate(_matrix(b.column(1), dim)):
                met, enough = {}, 0
                for n, leaf in enumerate(tree.visit(q), 1):
                    if leaf in held:
                        met.setdefault(shelf_of[leaf], []).append(leaf)
                        enough += held[leaf]
                    if n >= visits and enough > k:
                        break
                at += [i] * len(met)
                shelf += list(met)
                leaves += list(met.values())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at, pa.int64())), b.column(1).take(pa.array(at, pa.int64())),
                 pa.array(shelf, pa.int64()), pa.array(leaves, pa.list_(pa.int64()))],
                names=["id", "vec", "shelf", "leaves"])

    asked = materialize(indexed.where(is_query).select("id", "vec").mapInArrow(
        to_visits, "id long, vec array<double>, shelf long, leaves array<long>"), "ann-visits")
    callers = {r.shelf: r["count"] for r in asked.groupBy("shelf").count().collect()}
    if not callers:
        return spark.createDataFrame([], schema)
    size: dict[int, int] = {}
    for leaf, shelf in shelf_of.items():
        size[shelf] = size.get(shelf, 0) + held[leaf]
    # tables of one row per leaf or shelf, bounded by the tree
    cut = spark.createDataFrame([(s, -(-size[s] // chunk), -(-n // query_block)) for s, n in callers.items()],
                                "shelf long, chunks int, blocks int")
    places = spark.createDataFrame(list(shelf_of.items()), "leaf long, shelf long")
    part = ["shelf", "chunk", "block"]
    data = (indexed.join(F.broadcast(places), "leaf").join(F.broadcast(cut), "shelf")
            .withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(1)), F.col("chunks")).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(*part, F.lit(False).alias("is_query"), "id", "vec", F.array("leaf").alias("leaves")))
    queries = (asked.join(F.broadcast(cut), "shelf")
               .withColumn("block", F.pmod(F.xxhash64("id", F.lit(2)), F.col("blocks")).cast("int"))
               .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
               .select(*part, F.lit(True).alias("is_query"), "id", "vec", "leaves"))
    found = data.unionByName(queries).groupBy(*part).applyInArrow(
        _score_cell(dim, k), "query_id long, vec_id long, score double")
    return _top(found, k).select("query_id", "rank", "vec_id", "score")
