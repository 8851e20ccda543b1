"""Whitening of embeddings by shifted Cholesky QR.

Quantised rows are centred at the mean of the fit list (each distinct vector once). A Gram pass reads the fit list once:
each task solves its centred rows against the triangular factors found so far, multiplies them with themselves, and Spark
adds the small matrices up by entry. The Cholesky factor of a Gram matrix is one more triangular factor; the first one is
shifted by a multiple of the identity, so that it exists for any data, and the passes after it bring the columns to
orthogonality. The composed factor R has the right singular vectors of the centred matrix, and its singular values: these
give the components, their eigenvalues and the whitened coordinates of every row.

Only matrices of (dimensions x dimensions) come to the driver; rows never do, and the number of passes does not depend on
their number.

Defined cases: rows with a null vector, or with a null, NaN or infinite component, are left out; rows with a null id and
repeated rows are rows like any (the fit list holds each vector once); vectors shorter than the longest are filled up with
zeros; a component whose variance is zero beside the first one's (to the precision of doubles) cannot be scaled to one and
is left out, so equal vectors alone, a single vector, or none, give no rows; components of equal variance span the same
space in any order; other columns are ignored. Deviations beyond 63 bits raise ``OverflowError``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekeep.llm.common import settled
from tablekeep.llm.negatives import quantised, usable
from tablekeep.session import Workspace, col

COMPONENTS = 4
# Gram passes at most; full-rank data need three or four.
PASSES = 8
# Entries of a Gram matrix that may be off the identity's, for columns that count as orthogonal.
ORTHOGONAL = 1e-13
UNIT = float(np.finfo(np.float64).eps) / 2
SAFE = 1 << 63


@dataclass(frozen=True)
class Centre:
    """Of the fit list: how many vectors, their longest length, the exact sum of each dimension, the largest component."""

    n: int
    sums: tuple[int, ...]
    largest: int

    @property
    def dims(self) -> int:
        return len(self.sums)

    def spread(self, x: np.ndarray) -> np.ndarray:
        """``n x - S``, exactly: machine integers where they hold it, else Python's."""
        if self.n * self.largest + max(map(abs, self.sums), default=0) >= SAFE:
            x = x.astype(object)
            return x * self.n - np.array(self.sums, object)
        return x * np.int64(self.n) - np.array(self.sums, np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.spread(x).astype(np.float64) / self.n

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Sums of squares of ``n x - S``, exactly."""
        away = self.spread(x)
        bound = int(np.abs(away).max(initial=0)) ** 2 * max(1, self.dims)
        squares = (away * away if bound < SAFE else away.astype(object) ** 2).sum(axis=1)
        if len(squares) and int(squares.max()) >= SAFE:
            raise OverflowError("a deviation beyond 63 bits")
        return squares.astype(np.int64)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists of integers as rows, the shorter ones filled up with zeros."""
    offsets = column.offsets.to_numpy()
    out = np.zeros((len(column), dims), np.int64)
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]] if len(column) else np.zeros(0, np.int64)
    out[np.arange(dims) < np.diff(offsets)[:, None]] = flat
    return out


# ---- passes over the fit list


def fit_list(rows: DataFrame, ws: Workspace) -> tuple[DataFrame, Centre]:
    """Each distinct vector once (copies go before the shuffle), filled up to the longest, with what centres it."""
    dims = rows.agg(F.max(F.size("x"))).first()[0] or 0
    filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("x")))
    fit = settled(rows.select(filled.alias("x")).distinct(), ws, "fit_list")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per task and dimension the sum, as text, since a sum may have more bits than a long; -1 is the row count."""
        n, total, largest = 0, [0] * dims, 0
        for batch in batches:
            x = _matrix(batch.column("x"), dims)
            n += len(x)
            largest = max(largest, int(np.abs(x).max(initial=0)))
            # Halves of the words, so that no sum of a batch overflows.
            high, low = (x >> np.int64(32)).sum(axis=0), (x & np.int64(0xFFFFFFFF)).sum(axis=0)
            total = [t + (int(h) << 32) + int(k) for t, h, k in zip(total, high, low)]
        yield pa.RecordBatch.from_pydict(
            {"i": list(range(-2, dims)), "value": [str(v) for v in (largest, n, *total)]}, pa.schema([("i", pa.int32()), ("value", pa.string())])
        )

    value = F.col("value").cast("decimal(38,0)")
    found = {
        r["i"]: int(r["most"] if r["i"] == -2 else r["total"])
        for r in fit.mapInArrow(sums, "i int, value string").groupBy("i").agg(F.sum(value).alias("total"), F.max(value).alias("most")).collect()
    }
    return fit, Centre(found.get(-1, 0), tuple(found.get(i, 0) for i in range(dims)), found.get(-2, 0))


def _added(fit: DataFrame, width: int, of_rows) -> np.ndarray:
    """The sum over all rows of the square matrix that ``of_rows(x)`` gives per batch, added up by entry in Spark."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            total += of_rows(batch.column("x"))
        # Gram matrices are symmetric: the upper triangle will do.
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "value": total[i, j]})

    entries = fit.mapInArrow(partial, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    out = np.zeros((width, width))
    for r in entries.collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["value"]
    return out


def gram(fit: DataFrame, centre: Centre, factors: list[np.ndarray]) -> np.ndarray:
    """``Q'Q`` of the centred rows after the triangular solves with all factors so far."""

    def of_rows(column: pa.Array) -> np.ndarray:
        q = centre.centred(_matrix(column, centre.dims)).T
        for r in factors:
            q = solved_below(r.T, q)
        return q @ q.T

    return _added(fit, centre.dims, of_rows)


def solved_below(lower: np.ndarray, right: np.ndarray, block: int = 32) -> np.ndarray:
    """``lower x = right`` by blocked forward substitution."""
    out = np.array(right, np.float64)
    for a in range(0, len(lower), block):
        b = min(a + block, len(lower))
        out[a:b] -= lower[a:b, :a] @ out[:a]
        out[a:b] = np.linalg.solve(lower[a:b, a:b], out[a:b])
    return out


def triangular_factor(g: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """The upper Cholesky factor of a Gram matrix, shifted if asked to or where rounding has left it indefinite."""
    d = len(g)
    # The published shift, by which the factor exists whatever the condition of the data.
    shift = 11 * (n * d + d * (d + 1)) * UNIT * float(np.trace(g)) if shifted else 0.0
    least = UNIT * d * float(np.trace(g))
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(least, 10 * shift)


# ---- components


@dataclass(frozen=True)
class Whitening:
    """Unit eigenvectors (columns), eigenvalues of the covariance by falling size, and its trace."""

    centre: Centre
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.vectors / np.sqrt(self.values)


def fitted(fit: DataFrame, centre: Centre, components: int = COMPONENTS) -> Whitening:
    """Orthogonalise until a Gram matrix is the identity, compose the factors, and take R's singular vectors."""
    factors: list[np.ndarray] = []
    if centre.n and centre.dims:
        for k in range(PASSES):
            g = gram(fit, centre, factors)
            # Directions without variance stay at zero, all others come to one.
            if not np.trace(g) or (k and np.abs(g @ g - g).max() <= ORTHOGONAL * centre.dims):
                break
            factors.append(triangular_factor(g, centre.n, shifted=k == 0))
    if not factors:
        return Whitening(centre, np.zeros((centre.dims, 0)), np.zeros(0), 0.0)
    r = factors[0]
    for f in factors[1:]:
        r = f @ r
    _, singular, vectors = np.linalg.svd(r)
    kept = singular[:components] > max(centre.n, centre.dims) * 2 * UNIT * singular[0]
    chosen = np.flatnonzero(kept & (singular[:components] > 0))
    return Whitening(centre, vectors[chosen].T, singular[chosen] ** 2 / centre.n, float((singular**2).sum()) / centre.n)


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest entry of (covariance of the whitened fit list, less the identity)."""
    centre, width = model.centre, len(model.values)
    if not width:
        return 0.0

    def of_rows(column: pa.Array) -> np.ndarray:
        w = np.column_stack([model.whitened(_matrix(column, centre.dims)), np.ones(len(column))])
        return w.T @ w

    total = _added(fit, width + 1, of_rows) / centre.n
    mean = total[:width, width]
    return float(np.abs(total[:width, :width] - np.outer(mean, mean) - np.eye(width)).max())


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, ws: Workspace, vector: str = "embedding", scale: int = 256, components: int = COMPONENTS) -> DataFrame:
    """``WHITENED`` per usable row of ``vec_id, <vector>`` and component: its coordinate along it, scaled to variance one."""
    known = rows.select(
        col("vec_id").cast("long").alias("vec_id"), quantised(col(vector), scale).alias("x"), usable(col(vector)).alias("__usable")
    ).where("__usable")
    known = known.select("vec_id", "x")
    fit, centre = fit_list(known, ws)
    model = fitted(fit, centre, components)
    error, width = identity_error(fit, model), len(model.values)
    explained = model.values / model.trace if width else np.zeros(0)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not width or not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), centre.dims)
            each, count = np.repeat(np.arange(len(x)), width), len(x) * width
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch.column("vec_id").take(pa.array(each)),
                    "component": pa.array(np.tile(np.arange(1, width + 1), len(x)), pa.int32()),
                    "n": np.full(count, centre.n),
                    "deviation": centre.deviation(x)[each],
                    "whitened": model.whitened(x).ravel(),
                    "explained": np.tile(explained, len(x)),
                    "identity_error": np.full(count, error),
                }
            )

    return known.mapInArrow(of, WHITENED)
