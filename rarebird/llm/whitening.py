"""Embedding whitening with covariances by polarisation.

A vector entry c becomes the whole number x = floor(256 * c). The fit list is each distinct x vector
once: n vectors with sums S per dimension. With the centred whole numbers z = n * x - S, one pass
sums z_i ** 2 for every dimension and (z_i + z_j) ** 2 for every pair of dimensions, exactly; then

    2 * cov(z_i, z_j) = var(z_i + z_j) - var(z_i) - var(z_j)

gives every cross-covariance from variances alone. The sums are whole numbers of any size: tasks add
them as 64-bit numbers where they fit, in 21-bit limbs where squares do not, as Python integers beyond
that, and Spark adds the tasks' partial sums as decimals. Only d * (d + 1) / 2 sums (d: the width of
a vector) and the d x d covariance reach the driver, which is a bound that no row count moves.

Edge cases: a null vector, one with a null or non-finite entry, and an empty one give no row; 256 * c
beyond a long is the nearest long; repeated rows are in the fit list once and in the result as often
as they occur; a null id stays null; vectors of several widths are refused with the widths; an empty
table gives an empty result. A component without variance (a constant table, one row, a rank below
the width) whitens to 0 and explains its share, 0 where there is no variance at all. Equal
eigenvalues leave their components free up to a rotation, the same one for all rows. ``deviation`` is
null beyond 38 digits. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Context, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarebird.llm.common import Scratch

SCALE = 256
COMPONENTS = 4
#: vectors that one vectorised step works on (limb products of so many rows fit 63 bits)
STEP_ROWS = 4096
_LIMB = 21
_MASK = (1 << _LIMB) - 1
#: partial sums travel as so many decimals of 80 bits each
_PARTS, _PART_BITS = 4, 80
_EXACT = Context(prec=60)


def quantised(vector: Column) -> Column:
    """floor(256 * c) of every entry, as longs."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))


def usable(vector: Column) -> Column:
    """Whether a vector is there, not empty, and holds finite entries only."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite)


def square_sums(w: np.ndarray, axis: int) -> np.ndarray:
    """Exact sums of squares along an axis of at most 2**20 entries, as Python integers."""
    if w.dtype == object:
        return (w * w).sum(axis)
    w = np.abs(w)
    top = int(w.max(initial=0))
    if top * top * w.shape[axis] < 1 << 63:
        return (w * w).sum(axis).astype(object)
    limbs = [w & _MASK, (w >> _LIMB) & _MASK, w >> (2 * _LIMB)]
    total = 0
    for a in range(3):
        for b in range(a, 3):
            times = (1 if a == b else 2) << (_LIMB * (a + b))
            total = total + (limbs[a] * limbs[b]).sum(axis).astype(object) * times
    return total


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, as 64-bit numbers where sums of two of them fit, else as Python integers."""
    top = max(int(x.max()), -int(x.min())) if x.size else 0
    if 2 * (n * top + max((abs(s) for s in sums), default=0)) < 1 << 62:
        return x * n - sums.astype(np.int64)
    return x.astype(object) * n - sums


def _matrices(batch: pa.RecordBatch, column: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, whole-number matrix) of slices of a batch."""
    for start in range(0, batch.num_rows, STEP_ROWS):
        part = batch.column(column).slice(start, STEP_ROWS)
        yield start, part.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def column_sums(x: np.ndarray) -> np.ndarray:
    """Rows, then the exact sum of each dimension."""
    small = x.size == 0 or max(int(x.max()), -int(x.min())) < 1 << 42
    return np.append(np.array([len(x)], object), (x.sum(0) if small else x.astype(object).sum(0)).astype(object))


def pair_squares(n: int, sums: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Sums of z_i ** 2 and (z_i + z_j) ** 2, in the order (0, 0), (0, 1), ... (1, 1), ..."""

    def run(x: np.ndarray) -> np.ndarray:
        z = centred(x, n, sums)
        out = []
        for i in range(z.shape[1]):
            w = z[:, i : i + 1] + z[:, i:]
            w[:, 0] = z[:, i]
            out.append(square_sums(w, 0))
        return np.concatenate(out)

    return run


def _totals(fit: DataFrame, width: int, size: int, of: Callable[[np.ndarray], np.ndarray]) -> list[int]:
    """Exact sums over the fit list of ``size`` whole numbers that ``of`` gives for a matrix of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, object)
        for batch in batches:
            for _, x in _matrices(batch, 0, width):
                total = total + of(x)
        held = [(k, int(v)) for k, v in enumerate(total) if v]
        parts = [[(1 if v > 0 else -1) * ((abs(v) >> (_PART_BITS * p)) & ((1 << _PART_BITS) - 1)) for _, v in held] for p in range(_PARTS)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in held], pa.int64())] + [pa.array([Decimal(v) for v in part], pa.decimal128(38)) for part in parts],
            names=["k"] + [f"p{p}" for p in range(_PARTS)])

    schema = "k long, " + ", ".join(f"p{p} decimal(38,0)" for p in range(_PARTS))
    summed = fit.mapInArrow(run, schema).groupBy("k").agg(*[F.sum(f"p{p}").alias(f"p{p}") for p in range(_PARTS)])
    out = [0] * size
    for row in summed.toLocalIterator():
        out[row["k"]] = sum(int(row[f"p{p}"]) << (_PART_BITS * p) for p in range(_PARTS))
    return out


@dataclass(frozen=True)
class Whitener:
    """``sums`` of the n fitted vectors, their covariance, and all components by falling eigenvalue
    (columns of ``axes``)."""

    n: int
    sums: np.ndarray
    covariance: np.ndarray
    values: np.ndarray
    axes: np.ndarray

    @property
    def width(self) -> int:
        return len(self.sums)

    def explained(self, component: int) -> float:
        trace = float(np.trace(self.covariance))
        return float(self.values[component]) / trace if trace > 0 else 0.0

    def weights(self, components: int) -> np.ndarray:
        """Columns that take a centred vector to its whitened coordinates (0 where there is no variance)."""
        values = self.values[:components]
        flat = values <= max(float(np.trace(self.covariance)), 0.0) * self.width * np.finfo(float).eps
        return np.where(flat, 0.0, self.axes[:, :components] / np.sqrt(np.where(flat, 1.0, values)))


def assemble(n: int, sums: list[int], squares: list[int]) -> Whitener:
    """The covariance from sums of squares by polarisation, and its components."""
    width = len(sums)
    rows, columns = np.triu_indices(width)
    own = {int(i): squares[k] for k, (i, j) in enumerate(zip(rows, columns)) if i == j}
    cov = np.zeros((width, width))
    for k, (i, j) in enumerate(zip(rows.tolist(), columns.tolist())):
        # whole numbers up to here: one rounding per entry
        cov[i, j] = cov[j, i] = own[i] / n**3 if i == j else (squares[k] - own[i] - own[j]) / (2 * n**3)
    values, axes = np.linalg.eigh(cov)
    values, axes = np.maximum(values[::-1], 0.0), axes[:, ::-1]
    signs = np.sign(axes[np.abs(axes).argmax(0), np.arange(width)])
    return Whitener(n, np.array(sums, object), cov, values, axes * np.where(signs == 0, 1.0, signs))


def fit_list(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Each distinct whole-number vector once, as column ``x``: combined before the shuffle, so that a
    vector of a third of the rows sends one row a task."""
    return vectors.where(usable(F.col(f"`{vector}`"))).select(quantised(F.col(f"`{vector}`")).alias("x")).distinct()


def fit(listed: DataFrame) -> Whitener | None:
    """The whitener of a frame with the vectors to fit in column ``x`` (None: there are none)."""
    widths = [r["d"] for r in listed.select(F.size("x").alias("d")).distinct().limit(20).collect()]
    if not widths:
        return None
    if len(widths) > 1:
        raise ValueError(f"vectors of different widths: {sorted(widths)}")
    d = widths[0]
    n, *sums = _totals(listed, d, d + 1, column_sums)
    squares = _totals(listed, d, d * (d + 1) // 2, pair_squares(n, np.array(sums, object)))
    return assemble(n, sums, squares)


def identity_error(listed: DataFrame, model: Whitener, components: int = COMPONENTS) -> float:
    """Largest entry of |covariance of the whitened fit list - identity|, measured on the vectors."""
    weights = model.weights(components)
    k, held = weights.shape[1], np.abs(weights).sum(0) > 0
    n, sums, width = model.n, model.sums, model.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            for _, x in _matrices(batch, 0, width):
                w = (centred(x, n, sums).astype(np.float64) / n) @ weights
                total += np.vstack([w.T @ w, w.sum(0)])
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int64()), pa.array(total.ravel())], names=["k", "v"])

    got = np.zeros((k + 1) * k)
    for row in listed.mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
        got[row["k"]] = row["v"]
    got = got.reshape(k + 1, k) / n
    off = got[:k] - np.outer(got[k], got[k]) - np.eye(k)
    return float(np.abs(off[np.ix_(held, held)]).max(initial=0.0))


def transform(vectors: DataFrame, model: Whitener, error: float, id_col: str = "vec_id", vector: str = "embedding",
              components: int = COMPONENTS) -> DataFrame:
    """A row per usable vector and component (from 1): id, component, n, deviation, whitened, explained,
    identity_error. One narrow stage."""
    k = min(components, model.width)
    weights, shares = model.weights(k), np.array([model.explained(c) for c in range(k)])
    n, sums, width = model.n, model.sums, model.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, x in _matrices(batch, 1, width):
                rows = len(x)
                z = centred(x, n, sums)
                whitened = (z.astype(np.float64) / n) @ weights
                far = [_EXACT.create_decimal(int(v)) if v < 10**38 else None for v in square_sums(z, 1)]
                at = pa.array(np.repeat(np.arange(rows), k))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(start, rows).take(at),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n, np.int64)),
                    pa.array(far, pa.decimal128(38)).take(at),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(shares, rows)),
                    pa.array(np.full(rows * k, error)),
                ], names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    read = vectors.where(usable(F.col(f"`{vector}`"))).select(F.col(f"`{id_col}`"), quantised(F.col(f"`{vector}`")).alias("__x"))
    kind = vectors.schema[id_col].dataType.simpleString()
    return read.mapInArrow(run, f"`{id_col}` {kind}, component int, n long, deviation decimal(38,0), whitened double, "
                                "explained double, identity_error double")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Fits on the distinct vectors and returns ``transform`` of all usable ones."""
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession)
    listed = scratch.keep(fit_list(vectors, vector), "fit-list")
    model = fit(listed)
    if model is None:
        kind = vectors.schema[id_col].dataType.simpleString()
        return spark.createDataFrame([], f"`{id_col}` {kind}, component int, n long, deviation decimal(38,0), whitened double, "
                                         "explained double, identity_error double")
    error = identity_error(listed, model, min(components, model.width))
    scratch.drop("fit-list")
    return transform(vectors, model, error, id_col, vector, components)
