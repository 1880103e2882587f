"""Near-duplicate vectors by PCA-ordered tiled comparison.

1. Equal vectors collapse to one class with a count of copies, so copies are never paired.
2. Unit vectors are turned to principal axes, the axis of largest second moment first. The axes come from a bounded
   sample; any orthonormal axes give the same products, so the sample only decides how soon a
   comparison can stop.
3. Classes get their rank along the first axis from a range sort and are cut into tiles of equal size. A
   tile knows its range on each leading axis; two tiles are paired only if their boxes come closer than the threshold's
   distance. Pairs of tiles are found by an equi-join on stretches of the first axis.
4. A pair of tiles is one task. It accumulates the products of the leading dimensions first; what the other
   dimensions can add is at most the product of the two suffix norms, and a pair of vectors whose bound
   is below the threshold is dropped. Survivors go on with the next dimensions, and those left are decided by the cosine
   of the original vectors in double precision.
5. A task returns, per linked class, its number of links and one edge of a spanning forest of the links it
   found, never the links themselves. Components come from the edges.

Vectors spread evenly over many dimensions cannot be told apart by boxes; then all pairs of tiles are compared,
and the work is quadratic in the number of different vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiflow.llm.common import finite_entries, hot_limit, join_counted
from lexiflow.llm.graph import connected_components
from lexiflow.operators.joins import broadcast_if_small
from lexiflow.operators.ranks import dense_ranks
from lexiflow.session import materialize, materialize_measured

THRESHOLD = 0.95
#: rows and bytes of the sample that the axes are fitted on
SAMPLE = 8_000
SAMPLE_BYTES = 1 << 25
#: a tile holds a share of the classes between these bounds, and at most so many bytes of vectors
TILES = 24
LEAST_TILE = 1024
MOST_TILE = 4096
TILE_BYTES = 1 << 26
#: leading axes whose ranges a tile knows, and dimensions of the first accumulation step
BOX_AXES = 8
LEAD = 16
#: rows of the first tile that are compared at once with the second tile
STRIP = 512
#: share of survivors up to which pairs are carried on one by one
SPARSE = 0.05
SEED = 13


def unit_rows(column: pa.Array, dim: int) -> np.ndarray:
    """Unit vectors, shorter ones padded with zeros; scaled first, so that no square overflows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    size = np.diff(ends)
    x = np.zeros((len(size), dim))
    x[np.arange(dim) < size[:, None]] = flat[ends[0]:ends[-1]]
    x /= np.abs(x).max(axis=1, keepdims=True, initial=0.0)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def principal_axes(unit: np.ndarray) -> np.ndarray:
    """Orthonormal axes in columns, the largest second moment first."""
    _, axes = np.linalg.eigh(unit.T @ unit)
    return axes[:, ::-1]


def _suffix_norms(z: np.ndarray, ends: list[int]) -> list[np.ndarray]:
    return [np.sqrt(np.einsum("ij,ij->i", z[:, e:], z[:, e:])) for e in ends]


def _steps(dim: int, lead: int) -> list[int]:
    """Ends of the accumulation steps: ``lead``, doubled up to ``dim``."""
    ends = [min(lead, dim)]
    while ends[-1] < dim:
        ends.append(min(2 * ends[-1], dim))
    return ends


def linked_pairs(xa: np.ndarray, xb: np.ndarray, za: np.ndarray, zb: np.ndarray, threshold: float,
                 same: bool, lead: int = LEAD, strip: int = STRIP):
    """Yields (rows of a, rows of b) of unit vectors with cosine at least ``threshold``, strip by strip.

    ``x`` are the vectors, ``z`` the same on principal axes. ``same``: both tiles are one, only
    pairs with the first row before the second are wanted.
    """
    dim = xa.shape[1]
    ends = _steps(dim, lead)
    # products of float32 coordinates are off by less than this
    slack = np.float32(1e-5 + 2.5e-7 * dim)
    fa, fb = za.astype(np.float32), zb.astype(np.float32)
    na, nb = ([n.astype(np.float32) for n in _suffix_norms(z, ends)] for z in (za, zb))
    least = np.float32(threshold) - slack
    for at in range(0, len(xa), strip):
        rows = slice(at, min(at + strip, len(xa)))
        begin = at if same else 0  # earlier columns were compared by earlier strips
        part = fa[rows, :ends[0]] @ fb[begin:, :ends[0]].T
        alive = part + na[0][rows, None] * nb[0][None, begin:] >= least
        if same:
            alive &= np.arange(rows.start, rows.stop)[:, None] < np.arange(begin, len(xb))[None, :]
        step = 1
        while step < len(ends) and alive.any() and alive.mean() > SPARSE:
            dims = slice(ends[step - 1], ends[step])
            part += fa[rows, dims] @ fb[begin:, dims].T
            alive &= part + na[step][rows, None] * nb[step][None, begin:] >= least
            step += 1
        if step == len(ends) and alive.mean() > SPARSE:
            alive &= xa[rows] @ xb[begin:].T >= threshold
            i, j = np.nonzero(alive)
            if len(i):
                yield i + at, j + begin
            continue
        i, j = np.nonzero(alive)
        so_far = part[i, j]
        i, j = i + at, j + begin
        for s in range(step, len(ends)):
            if not len(i):
                break
            dims = slice(ends[s - 1], ends[s])
            so_far = so_far + np.einsum("ij,ij->i", fa[i, dims], fb[j, dims])
            keep = so_far + na[s][i] * nb[s][j] >= least
            i, j, so_far = i[keep], j[keep], so_far[keep]
        if len(i):
            keep = np.einsum("ij,ij->i", xa[i], xb[j]) >= threshold
            if keep.any():
                yield i[keep], j[keep]


def join_labels(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Merge the classes of ``u[i]`` and ``v[i]`` for all i; ``label`` points to the smallest member."""
    while len(u):
        a, b = label[u], label[v]
        apart = a != b
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label[:] = label[label]


def _compare_tiles(dim: int, axes: np.ndarray, threshold: float):
    def run(cell: pa.Table) -> pa.Table:
        # in the order of the nodes, so that every task names a component by the smallest node it sees
        cell = cell.sort_by("node")
        second = cell.column("second").to_numpy()
        node, copies = cell.column("node").to_numpy(), cell.column("copies").to_numpy()
        x = unit_rows(cell.column("vec"), dim)
        z = x @ axes
        a = np.flatnonzero(~second)
        b = np.flatnonzero(second)
        same = not len(b)
        b = a if same else b
        links = np.zeros(len(node), np.int64)
        label = np.arange(len(node))
        for i, j in linked_pairs(x[a], x[b], z[a], z[b], threshold, same):
            i, j = a[i], b[j]
            links += np.bincount(i, copies[j], len(node)).astype(np.int64)
            links += np.bincount(j, copies[i], len(node)).astype(np.int64)
            join_labels(label, i, j)
        met = np.flatnonzero(links)
        return pa.table({"node": pa.array(node[met]), "links": pa.array(links[met]),
                         "to": pa.array(node[label[met]])})

    return run


def _tile_pairs(tiled: DataFrame, axes: int, reach: float) -> DataFrame:
    """(tile, other), tile <= other: tiles whose boxes on the leading axes are at most ``reach`` apart."""
    boxes = tiled.groupBy("tile").agg(*[f(f"z{k}").alias(f"{n}{k}") for k in range(axes)
                                        for n, f in (("lo", F.min), ("hi", F.max))])
    boxes = materialize(boxes, "embedding-boxes")
    other = boxes.select(*[F.col(c).alias(f"o_{c}") for c in boxes.columns])
    # a tile lies on these stretches of the first axis; a partner begins at most one stretch after its end
    width = F.lit(reach)

    def stretch(c):
        return F.floor(F.col(c) / width)

    here = boxes.withColumn("stretch", F.explode(F.sequence(stretch("lo0") - 1, stretch("hi0") + 1)))
    there = other.withColumn("o_stretch", F.explode(F.sequence(stretch("o_lo0"), stretch("o_hi0"))))
    apart = F.lit(0.0)
    for k in range(axes):
        gap = F.greatest(F.lit(0.0), F.col(f"o_lo{k}") - F.col(f"hi{k}"), F.col(f"lo{k}") - F.col(f"o_hi{k}"))
        apart = apart + gap * gap
    return (here.join(there, (F.col("stretch") == F.col("o_stretch")) & (F.col("tile") <= F.col("o_tile"))
                      & (apart <= F.lit(reach * reach)))
            .select("tile", F.col("o_tile").alias("other")).distinct())


def class_links(classes: DataFrame, dim: int, n: int, threshold: float,
                tile_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(links, edges) of different vectors ``classes(node, copies, vec)``.

    ``links(node, links)``: rows of other classes that a row of the class links with, for classes with any;
    ``edges(a, b)``: a graph with the same components as all links.
    """
    most = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * dim)))
    share = min(1.0, most / n)
    unit = F.pmod(F.xxhash64("node", F.lit(SEED)), F.lit(1_000_000)) / F.lit(1e6)
    drawn = classes.where(unit < F.lit(share)).select("vec").limit(2 * most).toArrow().column("vec")
    axes = principal_axes(unit_rows(drawn, dim)) if len(drawn) else np.eye(dim)
    box = min(BOX_AXES, dim)

    def to_axes(batches):
        for b in batches:
            lead = unit_rows(b.column(2), dim) @ axes[:, :box] if b.num_rows else np.empty((0, box))
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(lead[:, k]) for k in range(box)]],
                                             names=["node", "copies", "vec", *[f"z{k}" for k in range(box)]])

    turned = classes.select("node", "copies", "vec").mapInArrow(
        to_axes, "node long, copies long, vec array<double>, " + ", ".join(f"z{k} double" for k in range(box)))
    size = tile_rows or max(1, min(max(LEAST_TILE, n // TILES), MOST_TILE, TILE_BYTES // (8 * dim)))
    ranked = dense_ranks(turned, ["z0"], alias="place", name="embedding-order")
    tiled = materialize(ranked.withColumn("tile", F.expr(f"place div {size}")).drop("place"), "embedding-tiles")
    # unit vectors with a cosine of t are sqrt(2 - 2 t) apart; the addition covers rounding
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6
    pairs, seen = materialize_measured(_tile_pairs(tiled, box, reach), "embedding-tile-pairs",
                                       {"n": F.count(F.lit(1))})
    pairs = broadcast_if_small(pairs, known_rows=seen["n"])
    rows = tiled.select(F.col("tile").alias("_tile"), "node", "copies", "vec")
    first = rows.join(pairs, F.col("_tile") == F.col("tile")).withColumn("second", F.lit(False))
    second = (rows.join(pairs, F.col("_tile") == F.col("other")).where("tile <> other")
              .withColumn("second", F.lit(True)))
    found = materialize(first.unionByName(second).drop("_tile").groupBy("tile", "other").applyInArrow(
        _compare_tiles(dim, axes, threshold), "node long, links long, to long"), "embedding-links")
    return (found.groupBy("node").agg(F.sum("links").alias("links")),
            found.where("node <> to").select(F.col("node").alias("a"), F.col("to").alias("b")))


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    threshold: float = THRESHOLD, tile_rows: int | None = None) -> DataFrame:
    """Per row: id, ``n_links`` (other rows with cosine at least ``threshold``), ``component_id`` (smallest id
    reachable by links, its own included), ``kept`` (id = component id).

    Defined cases: null and zero vectors and those with null or non-finite entries link with nothing and are
    their own component; a vector shorter than others is read as padded with zeros; equal rows link with
    each other, also if they share an id; a row without an id takes part and gets the smallest known id of its
    component (null if there is none, and is kept then); an empty table gives an empty result; other columns
    are not read.
    """
    vec = F.col("vec")
    read = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    usable = finite_entries(vec) & F.exists(vec, lambda c: c != 0)
    # two 64-bit hashes of unlike seeds stand for the vector
    mark = F.concat(F.hex(F.xxhash64(vec)), F.lit(":"), F.hex(F.xxhash64(F.lit(SEED), vec)))
    base, seen = materialize_measured(
        read.withColumn("mark", F.when(F.coalesce(usable, F.lit(False)), mark)), "embedding-rows",
        {"n": F.count("mark"), "dim": F.max(F.when(F.col("mark").isNotNull(), F.size(vec)))})
    alone = base.where("mark is null").select(
        F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
        F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    if not seen["n"]:
        return alone
    marked = base.where("mark is not null")
    grouped = marked.groupBy("mark").agg(F.min("vec").alias("vec"), F.min("id").alias("low"),
                                         F.count(F.lit(1)).alias("copies"))
    classes, m = materialize_measured(grouped.withColumn("node", F.monotonically_increasing_id()),
                                      "embedding-classes", {"n": F.count(F.lit(1))})
    links, edges = class_links(classes, seen["dim"], m["n"], threshold, tile_rows)
    labels = connected_components(edges)
    most = hot_limit(seen["n"])
    own = classes.select(F.col("node").alias("of"), "low", "mark", "copies")
    linked = own.join(labels, F.col("of") == F.col("node")).select("of", "low", "label")
    lowest = linked.groupBy(F.col("label").alias("root")).agg(F.min("low").alias("component_id"),
                                                              F.count(F.lit(1)).alias("_k"))
    placed = join_counted(linked, lowest, "label", "root", most).select(F.col("of").alias("node"), "component_id")
    met = links.join(placed, "node")
    per_class = own.join(met, F.col("of") == F.col("node"), "left").select(
        F.col("mark").alias("class"), F.col("copies").alias("_k"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
        F.coalesce("component_id", "low").alias("component_id"))
    per_class = materialize(per_class, "embedding-components")
    out = join_counted(marked.select("id", "mark"), per_class, "mark", "class", most)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept")).unionByName(alone)
