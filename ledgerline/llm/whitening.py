"""Embedding whitening: the leading components of a column of vectors by a randomised range finder.

Components become integers x = floor(256 * c) + 0. The fit list holds each distinct x vector once (one shuffle with partial
distinct, stored in the shared folder); n and the sums S are exact. A random matrix of ``want`` + ``OVER`` columns is multiplied by
the covariance V in ``POWERS`` + 1 passes over all centred rows, orthonormalised after each; Rayleigh-Ritz in its range gives
components, and one pass more their residuals. If a residual is too large for the gap to the next value (flat spectra), the range is
widened to the full dimension, where Rayleigh-Ritz is the whole eigenproblem. A task's share of a pass is one length x columns
matrix; Spark adds them in two steps, and the driver only sees the total. Each product is centred before it is multiplied.

Edge cases: rows whose vector is null or holds a null or a non-finite component are dropped; an empty table gives an empty one. A null id
is kept. Repeated rows count once in the fit and are all returned; other columns are not read. With fewer than ``want`` dimensions
there are as many components as dimensions. A component without variance (its value at most 1e-12 of the trace, such as with one
distinct row) has whitened 0 and explained 0, which identity_error then shows as 1. Of equal values any orthonormal basis is right,
and which one is found may change from run to run. Vectors of several lengths, more than 4096 components (the full covariance must
fit the driver) and components of 2**31 or more after scaling are errors. deviation is null where it exceeds a long;
deviation_exact always holds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import vectors as V
from .common import in_batches, stored

SCALE, WANT, OVER, POWERS = 256, 4, 8, 2
LIMIT = (1 << 31) - 1
MAX_LENGTH = 4096
#: A residual may be so large against its distance to the next value (the error of a component's direction).
ANGLE = 1e-9
#: A value of at most so much of the trace is no variance.
NOTHING = 1e-12
FIT, OUT = "fit", "vec_id long, component int, n long, deviation long, whitened double, explained double, deviation_exact decimal(38,0)"


class Model:
    """n, S (exact integers), mean, components (length x k, unit columns), values (k), trace, and the matrix that whitens centred rows."""

    def __init__(self, n: int, sums: list[int], components: np.ndarray, values: np.ndarray, trace: float):
        self.n, self.sums, self.components, self.values, self.trace = n, sums, components, values, trace
        self.mean = np.array([s / n for s in sums])
        self.real = values > NOTHING * trace
        self.matrix = components * np.where(self.real, 1 / np.sqrt(np.where(self.real, values, 1)), 0)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.matrix

    def explained(self) -> np.ndarray:
        return np.where(self.real, self.values / self.trace if self.trace > 0 else 0.0, 0.0)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum of (n * x - S)**2 over dimensions, exact."""
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        if most * most * max(len(self.sums), 1) < 1 << 63:
            d = self.n * x - np.array(self.sums, np.int64)
            return (d * d).sum(1).tolist()
        d = self.n * x.astype(object) - np.array(self.sums, object)
        return (d * d).sum(1).tolist()


def _sum_matrix(rows: DataFrame, shape: tuple[int, int], of) -> np.ndarray:
    """The sum over batches of `of(rows x length matrix of doubles)`, a matrix of `shape`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for b in batches:
            if b.num_rows:
                total += of(b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(float))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], names=["at", "v"])

    out = np.zeros(shape[0] * shape[1])
    for r in V.summed(in_batches(rows.select("x"), run, "at long, v double"), "at").toLocalIterator():
        out[r["at"]] = r.v
    return out.reshape(shape)


def fit_list(df: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """Each distinct integer vector once, as column x; stored."""
    rows = V.usable(df, vec_col)
    return stored(rows.select(F.transform("vec", lambda c: F.floor(c * SCALE).cast("long")).alias("x")).distinct())


def fit(df: DataFrame, vec_col: str = "embedding", want: int = WANT, over: int = OVER, powers: int = POWERS, seed: int = 7, told: dict | None = None) -> tuple[Model | None, DataFrame]:
    """The model and the fit list. `told` gets `width`, the columns of the range in which the components were found."""
    size = V.length(V.usable(df, vec_col))
    rows = fit_list(df, vec_col)
    if not size:
        return None, rows
    if size > MAX_LENGTH:
        raise ValueError(f"{size} components, more than {MAX_LENGTH}")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(size, object), 0
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) if b.num_rows else np.zeros((0, size), np.int64)
            if np.abs(x).max(initial=0) > LIMIT:
                raise ValueError(f"a component is beyond {LIMIT} after scaling by {SCALE}")
            total += x.sum(0)
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(size + 1), pa.int64()), pa.array([int(t) for t in (*total, n)], pa.int64())], names=["at", "v"])

    exact = in_batches(rows, sums, "at long, v long").withColumn("v", F.col("v").cast("decimal(28,0)"))
    total = {r["at"]: int(r.v) for r in V.summed(exact, "at").collect()}
    n, S = total[size], [total[i] for i in range(size)]
    mean = np.array([s / n for s in S])

    def times(q: np.ndarray) -> tuple[np.ndarray, float]:
        """V q and the trace of V, by one pass."""
        shipped = df.sparkSession.sparkContext.broadcast((mean, q))

        def part(x: np.ndarray) -> np.ndarray:
            m, v = shipped.value
            x = x - m
            return np.column_stack((x.T @ (x @ v), (x * x).sum(0)))

        total = _sum_matrix(rows, (size, q.shape[1] + 1), part) / n
        return total[:, :-1], float(total[:, -1].sum())

    def ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Values (falling), components and residuals in the range of q."""
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        return values, q @ turn, np.linalg.norm(vq @ turn - (q @ turn) * values, axis=0)

    k = min(want, size)
    width = min(size, want + over)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, width)))[0]
    for _ in range(powers if width < size else 0):
        q = np.linalg.qr(times(q)[0])[0]
    vq, trace = times(q)
    values, components, residual = ritz(q, vq)
    if width < size:
        gap = np.abs(np.diff(values))[:k]
        gap[1:] = np.minimum(gap[1:], np.abs(np.diff(values))[: k - 1])
        if (residual[:k] > ANGLE * gap).any():  # not converged: the whole space
            q = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))[0]
            values, components, _ = ritz(q, times(q)[0])
            width = size
    if told is not None:
        told["width"] = width
    return Model(n, S, components[:, :k], np.maximum(values[:k], 0), trace), rows


def identity_error(model: Model, rows: DataFrame) -> float:
    """Largest absolute entry of the fit list's whitened covariance, minus the identity: the rows are centred before they are
    multiplied, and what is left of their mean by rounding is taken off."""
    shipped = rows.sparkSession.sparkContext.broadcast(model)
    k = model.components.shape[1]

    def part(x: np.ndarray) -> np.ndarray:
        w = shipped.value.whiten(x)  # of centred rows
        return np.vstack((w.T @ w, w.sum(0)))

    total = _sum_matrix(rows, (k + 1, k), part) / model.n
    centre = total[-1]
    return float(np.abs(total[:-1] - np.outer(centre, centre) - np.eye(k)).max())


def transform(df: DataFrame, model: Model, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """A row for each row that counts and each component."""
    shipped = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        k, explained = m.components.shape[1], m.explained()
        wide = pa.decimal128(38, 0)
        for b in batches:
            x = V.matrix(b.column(1), SCALE, LIMIT)
            if not len(x):
                continue
            exact = m.deviations(x)
            each = np.repeat(np.arange(len(x)), k)
            long = pa.array([d if d < 1 << 63 else None for d in exact], pa.int64())
            dec = long.cast(wide) if long.null_count == 0 else pa.array(exact, wide)
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(each), m.n)), long.take(pa.array(each)),
                pa.array(m.whiten(x).ravel()), pa.array(np.tile(explained, len(x))), dec.take(pa.array(each)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "deviation_exact"])

    return in_batches(V.usable(df, vec_col, id=F.col(id_col).cast("long")), run, OUT)


def digest(df: DataFrame) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact."""
    model, rows = fit(df)
    if model is None:
        return df.sparkSession.createDataFrame([], OUT).withColumn("identity_error", F.lit(0.0))
    return transform(df, model).withColumn("identity_error", F.lit(identity_error(model, rows)))
