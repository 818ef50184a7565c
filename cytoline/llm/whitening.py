"""Whitening of embeddings: principal components by a randomised range finder, rows projected on them at unit variance.

A random block of vectors, some more than the components asked for, is multiplied by the covariance in passes over all
centred rows. Rayleigh-Ritz on the block's span gives components after every pass, and their residuals with them, as
the product that carries the block on is the one the residuals need. When residuals stay too large after the last
power pass, the block is expanded to the full dimension, where one more pass gives every component.

Only sums of the size of the block (d by l, d the number of dimensions) leave the tasks. Spark adds them up by entry,
and the driver works on matrices of d by d at most, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column
from .vectors import integers, matrix, most_common_size

#: Vectors that the block has beyond the components asked for.
OVERSAMPLING = 10
#: Power passes before the block is expanded to the full dimension.
POWER_PASSES = 3
#: A component's residual, as a share of the largest eigenvalue, at which it counts as found to double precision.
RESIDUAL = 1e-13
#: Eigenvalues of less than this share of the largest one are rounding: those components have no variance.
NO_VARIANCE = 1e-12


@dataclass(frozen=True)
class Whitening:
    """What :func:`fit` has found. ``basis`` has a column, and ``values`` an eigenvalue, for each component."""

    d: int
    n: int
    sums: np.ndarray
    basis: np.ndarray
    values: np.ndarray
    trace: float
    passes: int
    expanded: bool
    scale: int
    offset: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Rows less the mean, in doubles: the mean's whole part goes while both are integers."""
        whole = self.sums // self.n
        return (x - whole) - (self.sums - whole * self.n) / self.n

    def factors(self) -> np.ndarray:
        """What centred rows are multiplied by; components without variance give not-a-number."""
        kept = self.values > NO_VARIANCE * max(self.values.max(initial=0.0), 0.0)
        return self.basis / np.sqrt(np.where(kept, self.values, np.nan))

    def deviations(self, x: np.ndarray) -> np.ndarray | list[int]:
        """Exact sums over dimensions of (n x - S) squared; in Python's integers where 64 bits would not hold them."""
        largest = self.n * int(np.abs(x).max(initial=0)) + int(np.abs(self.sums).max(initial=0))
        if largest**2 * max(self.d, 1) < 2**63:
            return ((self.n * x - self.sums) ** 2).sum(1)
        whole = x - self.sums // self.n
        rest = self.sums % self.n
        largest = self.n * (int(np.abs(whole).max(initial=0)) + 1)
        if largest**2 * max(self.d, 1) < 2**63:
            return ((self.n * whole - rest) ** 2).sum(1)
        return [sum((self.n * int(v) - int(r)) ** 2 for v, r in zip(row, rest)) for row in whole]


def _rows(df: DataFrame, vec_col: str, scale: int, offset: int, id_col: str | None = None) -> DataFrame:
    good, x = integers(df, vec_col, scale, offset)
    return df.filter(good).select(*([column(df, id_col).alias("id")] if id_col else []), x.alias("x"))


def _added(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], size: int, d: int, kind: str = "double") -> np.ndarray:
    """``part`` of every batch of rows, added up within each task and then, entry by entry, by Spark."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                one = part(matrix(batch.column(0), d))
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(size), pa.int32()), "v": pa.array(total)})

    sums = rows.select("x").mapInArrow(of_task, f"at int, v {kind}").groupBy("at").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size, np.int64 if kind == "long" else np.float64)
    for r in sums:
        out[r["at"]] = r["v"]
    return out


def fit(vectors: DataFrame, components: int = 32, scale: int = 64, offset: int = 1_000_000, vec_col: str = "embedding",
        oversampling: int = OVERSAMPLING, power_passes: int = POWER_PASSES, seed: int = 0) -> Whitening:
    """Components of the covariance of all vectors, taken as ``floor(scale * entry) + offset``.

    Vectors that are null or hold a null or an entry that is not finite are left out, and so are those with another
    number of entries than most have (of numbers equally common the larger counts). Repeated rows count each time.
    Without vectors there are no components. At most as many components exist as dimensions.
    """
    rows = _rows(vectors, vec_col, scale, offset)
    d, n = most_common_size(rows)
    if not n or not d:
        return Whitening(d, n, np.zeros(d, np.int64), np.zeros((d, 0)), np.zeros(0), 0.0, 0, False, scale, offset)
    rows = rows.filter(F.size("x") == d)
    sums = _added(rows, lambda x: x.sum(0), d, d, "long")
    start = Whitening(d, n, sums, np.zeros((d, 0)), np.zeros(0), 0.0, 0, False, scale, offset)

    def product(q: np.ndarray) -> tuple[np.ndarray, float]:
        """The covariance times ``q``, and its trace: one pass over all rows."""

        def part(x: np.ndarray) -> np.ndarray:
            y = start.centred(x)
            return np.append((y.T @ (y @ q)).ravel(), (y * y).sum())

        total = _added(rows, part, d * q.shape[1] + 1, d) / n
        return total[:-1].reshape(q.shape), float(total[-1])

    def ritz(q: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Values and vectors in the span of ``q``, largest first, and the norms of their residuals."""
        small = q.T @ w
        values, inner = np.linalg.eigh((small + small.T) / 2)
        values, inner = values[::-1][:k], inner[:, ::-1][:, :k]
        return values, q @ inner, np.linalg.norm(w @ inner - (q @ inner) * values, axis=0)

    k, random = min(components, d), np.random.default_rng(seed)
    q = np.linalg.qr(random.standard_normal((d, min(d, k + oversampling))))[0]
    passes, expanded = 0, q.shape[1] == d
    while True:
        w, trace = product(q)
        passes += 1
        values, basis, residuals = ritz(q, w)
        if q.shape[1] == d or residuals.max(initial=0.0) <= RESIDUAL * max(values.max(initial=0.0), 0.0):
            break
        if passes <= power_passes:
            q = np.linalg.qr(w)[0]
        else:
            q, expanded = np.linalg.qr(np.concatenate([w, random.standard_normal((d, d - w.shape[1]))], 1))[0], True
    basis = basis * np.where(basis[np.abs(basis).argmax(0), np.arange(k)] < 0, -1.0, 1.0)
    return Whitening(d, n, sums, basis, np.maximum(values, 0.0), trace, passes, expanded, scale, offset)


def identity_error(vectors: DataFrame, model: Whitening, vec_col: str = "embedding") -> float:
    """The largest entry, without sign, of the covariance of all whitened rows less the identity: one more pass.

    Components without variance are left out of it. 0 without rows or components.
    """
    factors = model.factors()
    factors = factors[:, ~np.isnan(factors).any(0)]
    k = factors.shape[1]
    if not model.n or not k:
        return 0.0
    rows = _rows(vectors, vec_col, model.scale, model.offset).filter(F.size("x") == model.d)

    def part(x: np.ndarray) -> np.ndarray:
        z = model.centred(x) @ factors
        return np.concatenate([(z.T @ z).ravel(), z.sum(0)])

    total = _added(rows, part, k * k + k, model.d) / model.n
    mean = total[k * k :]
    return float(np.abs(total[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """A row for each vector that takes part and each component from 1:
    ``id, component, n, deviation, whitened, explained, identity_error``.

    ``deviation`` is a decimal of 38 digits, as it grows with the square of the number of rows. A null id stays null, and
    rows that repeat an id are rows of their own. For a component without variance ``whitened`` is null; ``explained``
    is 0 where no vector differs from another. An empty table gives an empty result.
    """
    k, error = model.basis.shape[1], identity_error(vectors, model, vec_col)
    rows = _rows(vectors, vec_col, model.scale, model.offset, id_col).filter(F.size("x") == model.d)
    factors = model.factors()
    explained = model.values / model.trace if model.trace > 0 else np.zeros(k)

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m or not k:
                continue
            x = matrix(batch.column(1), model.d)
            z = (model.centred(x) @ factors).ravel()
            exact = model.deviations(x)
            exact = pa.array(exact) if isinstance(exact, np.ndarray) else pa.array([Decimal(v) for v in exact], pa.decimal128(38, 0))
            row = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_pydict({
                "id": batch.column(0).take(row), "component": pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                "n": pa.array(np.full(m * k, model.n)), "deviation": exact.cast(pa.decimal128(38, 0)).take(row),
                "whitened": pa.array(z, mask=np.isnan(z)), "explained": pa.array(np.tile(explained, m)),
                "identity_error": pa.array(np.full(m * k, error)),
            })

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(of_task, f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
