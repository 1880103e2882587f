"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows form a tall matrix A that is only ever read by Spark; the driver holds vectors of the
embedding's own length. With ``A V = U B``, B upper bidiagonal, the small SVD of B gives the right singular
vectors of A, which are the principal components, and its singular values, which are their deviations.

One step is one scan: every partition forms ``t = A q`` for its rows and sums ``A' t``, ``U' t``
and ``t' t``; sums of partitions are added up in Spark. The left vectors are never stored: ``u_j = A w_j`` for
a short vector ``w_j`` kept beside ``v_j``, so a row's entries of U are a small product with that row, and
reorthogonalising ``u`` is a change of ``q``. Both sides are fully reorthogonalised at every step; where the norm of a
new left vector falls by cancellation, a second scan orthogonalises it again. An invariant subspace
(equal eigenvalues, low rank) ends in a vanishing beta; the iteration then goes on from a new start vector
orthogonal to all former ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.llm.common import finite_entries
from lexiflow.session import materialize

COMPONENTS = 8
SCALE = 1024
OFFSET = 100_000
#: scaled entries beyond this are held at it, so that sums of a batch fit a long
CLAMP = 1 << 40
#: up to this length all of the spectrum is found; longer vectors stop when the wanted triples have settled
FULL_LENGTH = 256
SETTLED = 1e-14
#: a beta or alpha below this share of the largest one so far is zero
VANISHED = 1e-12
#: a component is given if its eigenvalue is above this share of the trace
LEAST_SHARE = 1e-18
SEED = 12


@dataclass
class Whitening:
    """A fitted model: counts and sums of the fit list, components in columns, falling eigenvalues."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def quantised(vec: Column) -> Column:
    """``floor(1024 c) + 100000`` of every entry, as longs."""
    most = float(CLAMP)
    return F.transform(vec.cast("array<double>"), lambda c: F.floor(F.greatest(
        F.lit(-most), F.least(F.lit(most), c * F.lit(float(SCALE))))).cast("long") + F.lit(OFFSET))


def _matrix(batch: pa.RecordBatch, column: int, dim: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


class Centred:
    """Rows ``x - S/n`` without rounding the mean: ``S = n * whole + rest``, so ``(x - whole) - rest / n``."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Per row the exact sum of ``(n x - S)**2``; None if it is no long."""
        step = x - self.whole
        bound = self.n * (int(np.abs(step).max(initial=0)) + 1)
        if len(self.whole) * bound * bound < 1 << 62:
            diff = self.n * step - self.rest
            return (diff * diff).sum(axis=1).tolist()
        exact = self.n * step.astype(object) - self.rest.astype(object)
        return [s if s < 1 << 63 else None for s in (exact * exact).sum(axis=1).tolist()]


def _summed(matrix: DataFrame, dim: int, per_batch) -> np.ndarray:
    """Sum over all rows of ``per_batch(x)``, a flat array of bounded length: one array per
    partition, added up entry by entry in Spark."""
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                one = per_batch(_matrix(batch, 0, dim))
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["part"])

    parts = matrix.select("x").mapInArrow(run, "part array<double>")
    rows = (parts.select(F.posexplode("part").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect())
    return np.array([r.v for r in sorted(rows, key=lambda r: r.i)])


def _orthogonal(r: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    if basis:
        q = np.array(basis)
        for _ in range(2):
            r = r - q.T @ (q @ r)
    return r


def bidiagonalise(products, dim: int, wanted: int, steps: int | None = None, seed: int = SEED):
    """(right vectors in columns, B) with ``A V = U B`` for the matrix behind ``products``.

    ``products(q, W)`` gives ``(A' t, U' t, t' t)`` with ``t = A q`` and ``U = A W``. Without ``steps``
    all directions are found; with them the iteration may end once the ``wanted`` leading triples have settled.
    """
    rng = np.random.default_rng(seed)
    right: list[np.ndarray] = []
    short: list[np.ndarray] = []  # w_j with u_j = A w_j
    back: list[np.ndarray] = []   # A' u_j
    alphas: list[float] = []
    betas: list[float] = []
    most = min(dim, steps or dim)
    v = _unit(rng.standard_normal(dim))
    while v is not None:
        q = v - betas[-1] * short[-1] if betas else v
        w = np.array(short).T if short else np.zeros((dim, 0))
        g = np.array(back).T if back else np.zeros((dim, 0))
        at, h, tt = products(q, w)
        q, at, left = q - w @ h, at - g @ h, tt - h @ h
        if left < 0.5 * tt:
            at, h, tt = products(q, w)
            q, at, left = q - w @ h, at - g @ h, tt - h @ h
        alpha = float(np.sqrt(max(left, 0.0)))
        scale = max([alpha, *alphas, *betas])
        if alpha <= VANISHED * scale or scale == 0.0:
            alpha, q, at = 0.0, np.zeros(dim), np.zeros(dim)
        else:
            q, at = q / alpha, at / alpha
        right.append(v)
        short.append(q)
        back.append(at)
        alphas.append(alpha)
        if len(right) == most:
            break
        r = _orthogonal(at - alpha * v, right)
        beta = float(np.linalg.norm(r))
        if beta <= VANISHED * scale:
            # an invariant subspace: go on from a direction that it does not hold
            betas.append(0.0)
            v = _unit(_orthogonal(rng.standard_normal(dim), right))
            continue
        if steps and len(right) >= 2 * wanted:
            p, s, _ = np.linalg.svd(_bidiagonal(alphas, betas))
            if (beta * np.abs(p[-1, :wanted]) <= SETTLED * s[0]).all():
                break
        betas.append(beta)
        v = _unit(_orthogonal(r / beta, right))
    return np.array(right).T, _bidiagonal(alphas, betas)


def _unit(v: np.ndarray) -> np.ndarray | None:
    norm = float(np.linalg.norm(v))
    return v / norm if norm > 0 else None


def _bidiagonal(alphas: list[float], betas: list[float]) -> np.ndarray:
    return np.diag(alphas) + np.diag(betas[:len(alphas) - 1], 1)


def fit_rows(rows: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int, int]:
    """(table of ``id, x``, length, count) of the rows that take part, written once."""
    vec = F.col(vec_col)
    valid = (rows.select(F.col(id_col).alias("id"), vec.alias("vec"))
             .where(finite_entries(F.col("vec")) & (F.size("vec") > 0)))
    table = materialize(valid.select("id", quantised(F.col("vec")).alias("x")), "whitening-rows")
    lengths = table.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not lengths:
        return table, 0, 0
    dim = lengths[0]["dim"]
    return table.where(F.size("x") == dim), dim, lengths[0]["count"]


def fit(matrix: DataFrame, dim: int, n: int, components: int = COMPONENTS,
        full_length: int = FULL_LENGTH) -> Whitening:
    """The leading components of the rows ``x`` of ``matrix``."""
    def sums_of(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(dim), pa.int32()), pa.array(_matrix(batch, 0, dim).sum(axis=0), pa.int64())],
                    names=["i", "s"])

    exact = (matrix.select("x").mapInArrow(sums_of, "i int, s long")
             .groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    sums = [int(r.s) for r in sorted(exact, key=lambda r: r.i)]
    centred = Centred(n, sums)

    def products(q: np.ndarray, w: np.ndarray):
        def step(x: np.ndarray) -> np.ndarray:
            a = centred.rows(x)
            t = a @ q
            return np.concatenate([t @ a, t @ (a @ w), [t @ t]])

        got = _summed(matrix, dim, step)
        return got[:dim], got[dim:-1], float(got[-1])

    trace = float(_summed(matrix, dim, lambda x: np.array([(centred.rows(x) ** 2).sum()]))[0]) / n
    if trace == 0.0:
        return Whitening(n, sums, np.zeros((dim, 0)), np.zeros(0), 0.0)
    right, b = bidiagonalise(products, dim, components, None if dim <= full_length else dim)
    _, s, vt = np.linalg.svd(b)
    values = s ** 2 / n
    keep = np.flatnonzero(values[:components] > LEAST_SHARE * trace)
    vectors = right @ vt.T[:, keep]
    vectors /= np.linalg.norm(vectors, axis=0)
    return Whitening(n, sums, vectors, values[keep], trace)


def identity_error(matrix: DataFrame, dim: int, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows less the identity."""
    centred, turn = Centred(model.n, model.sums), model.components / np.sqrt(model.eigenvalues)
    k = turn.shape[1]
    mean = _summed(matrix, dim, lambda x: (centred.rows(x) @ turn).sum(axis=0)) / model.n

    def spread(x: np.ndarray) -> np.ndarray:
        y = centred.rows(x) @ turn - mean
        return (y.T @ y).ravel()

    cov = _summed(matrix, dim, spread).reshape(k, k) / model.n
    return float(np.abs(cov - np.eye(k)).max())


def whiten(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
           components: int = COMPONENTS, full_length: int = FULL_LENGTH) -> DataFrame:
    """Per remaining row and component: id, ``component`` (from 1), ``n``, ``deviation``, ``whitened``,
    ``explained``, ``identity_error``.

    Entries are quantised to ``x = floor(1024 c) + 100000``; covariances are those of x over all remaining
    rows, divisor n. ``deviation`` is the exact sum of ``(n x - S)**2`` over the dimensions.

    Defined cases: rows with a null or empty vector or with null or non-finite entries are left out, and so are
    those of another length than the commonest one (ties: the shortest); zero vectors, repeated rows and null
    ids take part; entries whose scaled size is beyond 2**40 are held there; a deviation that is no long is
    null; directions without any variance have no whitened value and are left out, so constant rows, one
    row and an empty table give an empty result; other columns are not read. Of exactly equal eigenvalues any
    basis may come out; of vectors longer than ``full_length`` the iteration ends when the leading
    triples have settled, which may then miss the second of two exactly equal ones.
    """
    spark = rows.sparkSession
    matrix, dim, n = fit_rows(rows, id_col, vec_col)
    id_type = matrix.schema["id"].dataType.simpleString()
    schema = (f"`{id_col}` {id_type}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    model = fit(matrix, dim, n, components, full_length) if n else None
    if model is None or not len(model.eigenvalues):
        return spark.createDataFrame([], schema)
    error = identity_error(matrix, dim, model)
    centred, turn = Centred(n, model.sums), model.components / np.sqrt(model.eigenvalues)
    k = turn.shape[1]
    explained = model.eigenvalues / model.trace

    def run(batches):
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x = _matrix(batch, 1, dim)
            at = pa.array(np.repeat(np.arange(m), k))
            deviation = pa.array(centred.deviations(x), pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                pa.array(np.full(m * k, n), pa.int64()), deviation.take(at),
                pa.array((centred.rows(x) @ turn).ravel()), pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, error))],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return matrix.select("id", "x").mapInArrow(run, schema)
