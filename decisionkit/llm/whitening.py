"""Whitening of embeddings by a singular value decomposition of the centred rows: blockwise QR, bidiagonal form, dqds, twisted factorisations.

1. An entry c becomes the integer floor(scale * c) + shift. Counts and sums per dimension are exact integers.
2. Each task centres its rows and folds them, block by block, into one triangular factor (QR of the factor so far stacked on the next block). The factors are folded
   the same way in rounds of ``FAN`` until one is left, so a task holds two small blocks at a time and the driver one d x d matrix.
3. Householder reflections from both sides bring that factor to bidiagonal form; its singular values are those of all rows.
4. dqds (the shifted quotient-difference iteration in differential form, which subtracts nothing but its shift) finds the squared singular
   values to high relative accuracy.
5. For each wanted value a twisted factorisation of the shifted tridiagonal form, joined where its pivot is least, gives the vector. A vector whose value lies close to another one
   is repeated with the earlier ones of that cluster projected out. The reflections carry the vectors back to the directions of the rows.
6. A row's whitened coordinates are its centred entries times the direction over the standard deviation there.

Nulls and odd rows: rows take part unless their vector is null, empty, holds a null or non-finite entry or one of magnitude 2**40 or more, or has another length than
most (of ties, the longer); a null id and repeated rows take part like any other; there are as many components as asked for, or as the rank of the rows if that is less, so
equal vectors, or a single one, have none; of equal eigenvalues (ties) any orthogonal directions may come first; an empty table gives an empty result; vectors
of any length are held one block of rows at a time, and d x d once; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

SCALE, SHIFT, FAN, BLOCK, LIMIT = 1024, 100_000, 32, 2048, float(2**40)
EPS = np.finfo(float).eps


# ---- bidiagonal form, dqds, twisted factorisations (d x d, after all rows are folded)


def householder(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """(v, tau, beta) with (I - tau v v') x = beta e1."""
    v, norm = x.astype(float).copy(), float(np.linalg.norm(x))
    if norm == 0.0 or not np.any(x[1:]):
        return v, 0.0, float(x[0])
    beta = -norm if x[0] >= 0 else norm
    v[0] -= beta
    return v, 2.0 / float(v @ v), beta


def bidiagonalised(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Diagonal, superdiagonal and the right-hand reflections of an upper bidiagonal form of a square matrix."""
    a, d = np.array(r, float), r.shape[1]
    diagonal, above, right = np.zeros(d), np.zeros(max(d - 1, 0)), []
    for k in range(d):
        v, tau, diagonal[k] = householder(a[k:, k])
        a[k:, k:] -= tau * np.outer(v, v @ a[k:, k:])
        if k + 1 < d:
            v, tau, above[k] = householder(a[k, k + 1 :])
            a[k:, k + 1 :] -= tau * np.outer(a[k:, k + 1 :] @ v, v)
            right.append((v, tau))
    return diagonal, above, right


def carried_back(vector: np.ndarray, right: list) -> np.ndarray:
    """A right singular vector of the bidiagonal form as one of the matrix."""
    out = vector.copy()
    for k in range(len(right) - 1, -1, -1):
        v, tau = right[k]
        out[k + 1 :] -= tau * (v @ out[k + 1 :]) * v
    return out


def _dqds_pass(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float] | None:
    """One differential step; nothing if the shift is above the least value."""
    n = len(q)
    new_q, new_e, d = np.empty(n), np.empty(n - 1), q[0] - shift
    least = d
    for k in range(n - 1):
        if d < 0:
            return None
        new_q[k] = d + e[k]
        if new_q[k] == 0.0:
            new_e[k], d = 0.0, q[k + 1] - shift
        else:
            ratio = q[k + 1] / new_q[k]
            new_e[k] = e[k] * ratio
            d = d * ratio - shift
        least = min(least, d)
    if d < 0:
        return None
    new_q[n - 1] = d
    return new_q, new_e, least


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling."""
    found, todo = [], [(np.square(diagonal), np.square(above), 0.0)]
    while todo:
        q, e, moved = todo.pop()
        for _ in range(60 * len(q) + 60):
            cut = np.flatnonzero(e <= EPS**2 * (q[:-1] + q[1:] + moved))
            if len(cut) or len(q) <= 1:
                break
            # the pivots bound the least value from above; a share of that is tried as shift, then less, then none, which always passes
            guess = min(float(q[-1]), float(q.min()))
            step = None
            guess *= max(0.0, 1 - 2 * np.sqrt(float(e[-1]) / (float(q[-1]) or 1.0)))
            for share in (0.98, 0.5, 0.1, 0.0):
                step = _dqds_pass(q, e, share * guess)
                if step:
                    moved += share * guess
                    break
            q, e, _ = step
        if len(q) <= 1:
            found += [float(x) + moved for x in q]
            continue
        if not len(cut):
            raise ArithmeticError("dqds did not converge")
        at = int(cut[-1])
        todo.append((q[: at + 1], e[:at], moved))
        todo.append((q[at + 1 :], e[at + 1 :], moved))
    return np.sort(np.maximum(found, 0.0))[::-1]


def twisted_vector(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B'B near ``value`` from its twisted factorisation: down to a place, up to it, joined where the pivot is least."""
    n = len(diagonal)
    if n == 1:
        return np.ones(1)
    main = np.square(diagonal)
    main[1:] += np.square(above)
    side = diagonal[:-1] * above
    tiny = EPS * (np.abs(main).max() + np.abs(side).max() + abs(value)) or 1.0
    solid = lambda x: x if abs(x) > tiny * EPS else tiny * EPS if x >= 0 else -tiny * EPS
    down, up = np.empty(n), np.empty(n)
    down[0], up[-1] = main[0] - value, main[-1] - value
    for k in range(1, n):
        down[k] = main[k] - value - side[k - 1] ** 2 / solid(down[k - 1])
        up[n - 1 - k] = main[n - 1 - k] - value - side[n - 1 - k] ** 2 / solid(up[n - k])
    at = int(np.abs(down + up - (main - value)).argmin())
    z = np.zeros(n)
    z[at] = 1.0
    for k in range(at - 1, -1, -1):
        z[k] = -side[k] * z[k + 1] / solid(down[k])
    for k in range(at + 1, n):
        z[k] = -side[k - 1] * z[k - 1] / solid(up[k])
    return z / np.linalg.norm(z)


def _solved(diagonal: np.ndarray, above: np.ndarray, value: float, right: np.ndarray) -> np.ndarray:
    """A step of inverse iteration on B'B - value, by elimination with row exchanges."""
    n = len(diagonal)
    main = np.square(diagonal)
    main[1:] += np.square(above)
    side = diagonal[:-1] * above
    a = np.diag(main - value) + np.diag(side, 1) + np.diag(side, -1)
    a += np.eye(n) * EPS * (np.abs(main).max() or 1.0)
    out = np.linalg.solve(a, right)
    return out / np.linalg.norm(out)


def right_singular(factor: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(squared singular values falling, the first ``wanted`` right singular vectors as columns); values that vanish have no vector."""
    diagonal, above, right = bidiagonalised(factor)
    squares = dqds(diagonal, above)
    if not len(squares) or squares[0] <= 0:
        return squares, np.zeros((factor.shape[1], 0))
    rank = int((squares > squares[0] * (len(squares) * EPS) ** 2 * 64).sum())
    small: list[np.ndarray] = []
    for k in range(min(wanted, rank)):
        z = twisted_vector(diagonal, above, squares[k])
        close = [small[j] for j in range(k) if squares[j] - squares[k] <= 1e-3 * squares[0]]
        if close:
            basis = np.stack(close, axis=1)
            for attempt in range(8):
                z = z - basis @ (basis.T @ z)
                norm = np.linalg.norm(z)
                z = z / norm - basis @ (basis.T @ (z / norm)) if norm else z
                if norm > 0.1:
                    break
                # the same vector again: begin elsewhere in the space of that value
                z = np.random.default_rng(97 * k + attempt).normal(size=len(z))
                z -= basis @ (basis.T @ z)
                z = _solved(diagonal, above, squares[k], z / np.linalg.norm(z))
        small.append(z / np.linalg.norm(z))
    vectors = [carried_back(z, right) for z in small]
    return squares, np.stack(vectors, axis=1) if vectors else np.zeros((factor.shape[1], 0))


# ---- the work over all rows


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    entries = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    rows = vectors.select(F.col(id_col).alias("vec_id"), entries.alias("entries"))
    fine = F.forall("entries", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < LIMIT), F.lit(False)))
    return rows.where(F.col("entries").isNotNull() & (F.size("entries") > 0) & fine)


def _integers(batch: pa.RecordBatch, scale: int, shift: int) -> np.ndarray:
    entries = batch.column("entries")
    flat = entries.flatten().to_numpy(zero_copy_only=False)
    return np.floor(scale * flat.reshape(len(entries), -1)).astype(np.int64) + shift


def _summed(scale: int, shift: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _integers(batch, scale, shift)
                n, total = n + len(x), x.sum(axis=0) + (0 if total is None else total)
        if n:
            yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "sums": pa.array([total.tolist()], pa.list_(pa.int64()))})

    return run


def _folded(factor: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows if factor is None else np.vstack([factor, rows]), mode="r")


def _bytes_of(factor: np.ndarray) -> bytes:
    return np.ascontiguousarray(factor, "<f8").tobytes()


def _factored(n: int, sums: np.ndarray, scale: int, shift: int):
    """One triangular factor per task. Rows are centred as integers, n x - S, and divided once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                x = _integers(batch.slice(at, BLOCK), scale, shift)
                factor = _folded(factor, centred(x, n, sums))
        if factor is not None:
            yield pa.RecordBatch.from_pydict({"factor": pa.array([_bytes_of(factor)], pa.binary())})

    return run


def _refolded(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = None
        for batch in batches:
            for one in batch.column("factor"):
                factor = _folded(factor, np.frombuffer(one.as_py(), "<f8").reshape(-1, width))
        if factor is not None:
            yield pa.RecordBatch.from_pydict({"factor": pa.array([_bytes_of(factor)], pa.binary())})

    return run


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n, from whole numbers: S = n m + r, and only r/n is rounded."""
    whole, rest = np.divmod(sums, n)
    return (x - whole) - rest / n


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Per row the exact sum of (n x - S)^2; null beyond a long."""
    whole, rest = np.divmod(sums, n)
    room = int(np.abs(x - whole).max(initial=0) + 1) * n
    if x.shape[1] * room * room < 2**63:
        d = (x - whole) * n - rest
        return (d * d).sum(axis=1).tolist()
    d = (x - whole).astype(object) * n - rest.astype(object)
    return [v if v < 2**63 else None for v in (int(s) for s in (d * d).sum(axis=1))]


@dataclass
class Whitening:
    """A fitted whitening: everything is of the size of the dimension, not of the rows."""

    n: int
    sums: np.ndarray
    values: np.ndarray  # eigenvalues of the covariance, falling, all of them
    directions: np.ndarray  # dimension x components, already over the standard deviations
    scale: int = SCALE
    shift: int = SHIFT

    def apply(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums) @ self.directions


def _one_length(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows of the most frequent length, and it."""
    sizes = rows.groupBy(F.size("entries").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    size = sizes["size"] if sizes else 0
    return rows.where(F.size("entries") == size), size


def fitted(vectors: DataFrame, components: int | None = 8, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """The whitening of all usable rows; nothing if there are none. ``components`` None means as many as the rank."""
    rows, width = _one_length(_usable(vectors, id_col, vector_col))
    if not width:
        return None
    partial = rows.select("entries").mapInArrow(_summed(scale, shift), "n long, sums array<long>")
    partial = staged(partial, "sums")
    n = partial.agg(F.sum("n")).first()[0]
    sums = {r["pos"]: r["total"] for r in partial.select(F.posexplode("sums")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("total")).collect()}
    exact = [int(sums[k]) for k in range(width)]
    sums = np.array(exact, np.int64) if max(map(abs, exact)) < 2**62 else np.array(exact, object)
    factors = staged(rows.select("entries").mapInArrow(_factored(n, sums, scale, shift), "factor binary"), "factors")
    many = factors.count()
    while many > 1:
        fewer = -(-many // FAN)
        factors = staged(factors.repartition(fewer).mapInArrow(_refolded(width), "factor binary"), "factors")
        many = factors.count()
    factor = np.frombuffer(factors.first()["factor"], "<f8").reshape(-1, width)
    factor = np.vstack([factor, np.zeros((width - len(factor), width))])
    squares, vectors_ = right_singular(factor, width if components is None else components)
    values = squares / n
    return Whitening(n, sums, values, vectors_ / np.sqrt(values[: vectors_.shape[1]]), scale, shift)


def _products(model: Whitening):
    """Per task the sums of the whitened coordinates and of their products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                w = model.apply(_integers(batch, model.scale, model.shift))
                one = np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tolist()], pa.list_(pa.float64()))})

    return run


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    k = model.directions.shape[1]
    sums = rows.select("entries").mapInArrow(_products(model), "sums array<double>").select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("total")).collect()
    total = np.array([r["total"] for r in sorted(sums, key=lambda r: r["pos"])]) / model.n
    mean, products = total[:k], total[k:].reshape(k, k)
    return float(np.abs(products - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def _applied(model: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = model.directions.shape[1]
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = _integers(part, model.scale, model.shift)
                whitened = pa.FixedSizeListArray.from_arrays(pa.array(model.apply(x).ravel()), k).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(deviations(x, model.n, model.sums), pa.int64()), whitened], names=["vec_id", "deviation", "whitened"])

    return run


def _explained(values: np.ndarray, k: int) -> Column:
    share = values / values.sum()
    return F.element_at(F.array(*[F.lit(float(v)) for v in share[:k]]), F.col("component"))


def whitened(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    kind = vectors.schema[id_col].dataType.simpleString()
    model = fitted(vectors, components, id_col, vector_col, scale, shift)
    if model is None or not model.directions.shape[1]:
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    rows = _usable(vectors, id_col, vector_col).where(F.size("entries") == len(model.sums))
    error = identity_error(rows, model)
    out = rows.mapInArrow(_applied(model), f"vec_id {kind}, deviation long, whitened array<double>")
    out = out.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).withColumn("component", F.col("place") + 1)
    return out.select("vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", _explained(model.values, model.directions.shape[1]).alias("explained"), F.lit(error).alias("identity_error"))
