"""Shared passes of a k search (M5, M7, M8): one pass over the vectors serves every candidate.

*Mixtures.* The EM rounds of all candidates run together: a pass computes the memberships of each row in
the components of every candidate that has not settled and sums their sufficient statistics, and the
driver updates all of them. The start, the update, the stop rule and the guard against empty densities are
those of Spark's estimator, whose model class the result is, so a candidate ends where a fit of its own
ends. The number of passes is the largest number of rounds instead of the sum, and there is one copy of
the vectors, packed in blocks, instead of one per running candidate.

*k-means.* Every candidate starts from the centres Spark's estimator starts from, and the Lloyd rounds of all
candidates run together over the same packed blocks, with that estimator's update and stop rule.

*Silhouettes.* One pass sums count, vector and squared norm per (candidate, cluster), a second one
averages the silhouettes of all candidates.

Tasks return one small array each; many tasks are added up in a second stage before the driver sees them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.clustering import GaussianMixture, GaussianMixtureModel, KMeans, KMeansModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarebird.functions.columns import vector_parts
from rarebird.operators.layout import has_exchange, partition_count

#: cells of the largest matrix a step of a task makes, and rows of a step at most
_CELLS, _STEP_ROWS = 1 << 20, 1024
#: bytes of packed rows in one value, at most where a step's rows are fewer
_VALUE_BYTES = 1 << 20
#: bytes of packed rows that are worth a task: of a small frame, up to so many tasks, and of a large one
_SMALL_TASK_BYTES, _SMALL_TASKS, _TASK_BYTES = 4 << 20, 24, 24 << 20
#: tasks whose sums the driver adds itself
_DIRECT_TASKS = 256
_EPSILON = 2.0**-52
#: rows averaged into the start of one component
_START_ROWS = 5
#: exponents below this vanish beside ``_EPSILON``; where they leave the normal numbers, ``exp`` is ten times slower
_VANISHED = -100.0


def dense_rows(column: pa.Array, width: int) -> np.ndarray:
    """A column of ML vectors (``vector_parts``) as a matrix."""
    kind = column.field("type").to_numpy(zero_copy_only=False)
    values = column.field("values")
    flat = values.flatten().to_numpy(zero_copy_only=False)
    if (kind == 1).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    lengths = np.diff(values.offsets.to_numpy())
    row = np.repeat(np.arange(len(column)), lengths)
    dense = kind[row] == 1
    out[kind == 1] = flat[dense].reshape(-1, width)
    out[row[~dense], column.field("indices").flatten().to_numpy(zero_copy_only=False)] = flat[~dense]
    return out


@dataclass(frozen=True)
class Blocks:
    """Rows packed as raw doubles (their labels and vector, ``width`` numbers, after a weight if ``weighted``),
    many of a partition in one value. ``values`` are bytes that go to the tasks as they are."""

    values: RDD
    width: int
    tasks: int
    weighted: bool

    def sums(self, of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all rows of the array that ``of(vectors, weights)`` gives for some of them."""
        width, front = self.width, int(self.weighted)
        step = min(_STEP_ROWS, max(64, _CELLS // (width * width)))

        def task(values: Iterator[bytes]) -> Iterator[bytes]:
            total, ones = None, np.ones(step)
            for raw in values:
                every = np.frombuffer(raw, np.float64).reshape(-1, front + width)
                for at in range(0, len(every), step):
                    rows = every[at : at + step]
                    got = of(rows[:, front:], rows[:, 0] if front else ones[: len(rows)])
                    total = got if total is None else total + got
            if total is not None:
                yield total.tobytes()

        def add(values: Iterator[bytes]) -> Iterator[bytes]:
            parts = [np.frombuffer(x, np.float64) for x in values]
            if parts:
                yield np.sum(parts, axis=0).tobytes()

        partial = self.values.mapPartitions(task)
        if self.tasks > _DIRECT_TASKS:
            partial = partial.repartition(math.isqrt(self.tasks)).mapPartitions(add)
        return np.sum([np.frombuffer(x, np.float64) for x in partial.collect()], axis=0)


def _tasks_for(size: int) -> int:
    """Tasks that ``size`` bytes of packed rows are worth."""
    return max(1, min(-(-size // _SMALL_TASK_BYTES), max(_SMALL_TASKS, -(-size // _TASK_BYTES))))


@contextmanager
def packed(df: DataFrame, features: str = "features", weight: str | None = None, labels: Sequence[str] = ()):
    """Blocks of a frame of vectors, persisted for the block of code; lost ones are packed again.

    A packed row is its weight (if there is one), its ``labels`` (columns of whole numbers) and its vector."""
    first = df.select(features).first()
    if first is None:
        raise ValueError("no rows")
    width, count = first[0].size, int(weight is not None) + len(labels)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(_VALUE_BYTES // (8 * (count + width)), 64)
        for batch in batches:
            vectors = dense_rows(batch.column(0), width)
            if not np.isfinite(vectors).all():
                raise ValueError("vectors hold NaN or infinite values")
            rows = np.column_stack([*[batch.column(1 + c).to_numpy(zero_copy_only=False) for c in range(count)], vectors])
            yield pa.RecordBatch.from_arrays([pa.array([rows[k : k + size].tobytes() for k in range(0, len(rows), size)], pa.binary())], names=["block"])

    tasks = _tasks_for(df.count() * 8 * (count + width))
    if (partition_count(df) or 0) > tasks:
        df = df.coalesce(tasks)  # narrow: frames are cut finer than a pass over packed rows needs
    front = [F.col(f"`{c}`").cast("double").alias(f"front_{i}") for i, c in enumerate([*([weight] if weight else []), *labels])]
    frame = df.select(vector_parts(features).alias("vector"), *front).mapInArrow(pack, "block binary")
    # bytes in an RDD: a pass over the rows of a cached frame would make rows and Arrow batches of them again
    values = frame.rdd.map(lambda row: bytes(row[0])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield Blocks(values, width + len(labels), values.getNumPartitions(), weight is not None)
    finally:
        values.unpersist()


# --------------------------------------------------------------------------- mixtures


class NoSpread(ValueError):
    """A component whose covariance is zero."""


@dataclass
class Mixture:
    """A candidate under fit: weights, means and covariances of its components."""

    k: int
    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    log_likelihood: float = -math.inf
    rounds: int = 0
    history: list[float] = field(default_factory=list)

    def densities(self) -> tuple[np.ndarray, np.ndarray]:
        """Per component: the root of the inverse covariance (a pseudo-inverse where it is singular)
        and the logarithm of the density's constant."""
        d = self.means.shape[1]
        roots, logs = np.empty((self.k, d, d)), np.empty(self.k)
        for i, cov in enumerate(self.covariances):
            values, axes = np.linalg.eigh((cov + cov.T) / 2)
            used = values > _EPSILON * values.max() * d
            if not used.any() or not np.isfinite(values).all():
                raise NoSpread(f"component {i} of k={self.k} has no spread")
            inverse = np.where(used, 1 / np.sqrt(np.where(used, values, 1.0)), 0.0)
            roots[i] = inverse[:, None] * axes.T
            logs[i] = -0.5 * (d * math.log(2 * math.pi) + np.log(values[used]).sum())
        return roots, logs


def start(df: DataFrame, features: str, k: int, seed: int, weight: str | None = None) -> Mixture:
    """The start of Spark's estimator: a seeded sample of ``5 k`` rows, the (weighted) mean and variances
    of five of them for each component."""
    return starts(df, features, [k], seed, weight)[0]


def starts(df: DataFrame, features: str, ks: Sequence[int], seed: int, weight: str | None = None) -> list[Mixture]:
    """:func:`start` for every k."""
    out = []
    for k, (rows, held) in zip(ks, _drawn(df, features, [k * _START_ROWS for k in ks], seed, weight)):
        rows, held = rows.reshape(k, _START_ROWS, -1), held.reshape(k, _START_ROWS, 1)
        means = (rows * held).sum(1) / held.sum(1)
        spreads = ((rows - means[:, None]) ** 2 * held).sum(1) / held.sum(1)
        out.append(Mixture(k, held.sum((1, 2)) / held.sum(), means, np.stack([np.diag(s) for s in spreads])))
    return out


def _drawn(df: DataFrame, features: str, sizes: Sequence[int], seed: int, weight: str | None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Vectors and weights of a ``takeSample`` of each size. Which rows it takes follows from their places in
    their partitions: where a plan has no exchange, places alone are drawn from, and the drawn rows of all
    sizes are read in one pass."""
    one = F.col(weight).cast("double") if weight else F.lit(1.0)
    if has_exchange(df):
        drawn = [df.select(features, one)._jdf.rdd().takeSample(True, size, seed) for size in sizes]
        return [(np.array([list(r.get(0).toArray()) for r in rows]), np.array([r.getDouble(1) for r in rows])) for rows in drawn]
    place = F.monotonically_increasing_id().alias("place")
    places = df.select(place)._jdf.rdd()
    drawn = [[r.getLong(0) for r in places.takeSample(True, size, seed)] for size in sizes]
    wanted = sorted({p for own in drawn for p in own})
    found = df.select(place, F.col(features).alias("row"), one.alias("held")).where(F.col("place").isin(wanted)).collect()
    at = {r["place"]: (r["row"].toArray(), r["held"]) for r in found}
    return [(np.array([at[p][0] for p in own]), np.array([at[p][1] for p in own])) for own in drawn]


class _Densities:
    """Weighted densities of all components of several mixtures, at once."""

    def __init__(self, mixtures: Sequence[Mixture]):
        both = [m.densities() for m in mixtures]
        roots, self.logs = np.concatenate([r for r, _ in both]), np.concatenate([c for _, c in both])[:, None]
        self.n, self.d, _ = roots.shape
        shift = np.einsum("nij,nj->ni", roots, np.concatenate([m.means for m in mixtures]))
        # a row per (entry, component); the last column meets the ones below the vectors
        self.turn = np.concatenate([roots, -shift[:, :, None]], axis=2).transpose(1, 0, 2).reshape(self.n * self.d, self.d + 1)
        self.weights = np.concatenate([m.weights for m in mixtures])[:, None]
        self.cuts = np.cumsum([0] + [m.k for m in mixtures])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """A row per component, a column per column of ``x`` (the vectors, and a row of ones below)."""
        off = (self.turn @ x).reshape(self.d, -1)
        far = np.einsum("ij,ij->j", off, off).reshape(self.n, -1)
        far *= -0.5
        far += self.logs
        np.maximum(far, _VANISHED, out=far)
        np.exp(far, out=far)
        far *= self.weights
        far += _EPSILON
        return far


def _expectation(mixtures: Sequence[Mixture]) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Per component the membership, the vector and the products of vector entries summed by membership,
    then per mixture the log likelihood: one flat array."""
    densities, width = _Densities(mixtures), mixtures[0].means.shape[1]
    pairs = list(zip(densities.cuts[:-1], densities.cuts[1:]))

    def of(x: np.ndarray, weight: np.ndarray) -> np.ndarray:
        terms = np.empty((width + 1 + width * (width + 1) // 2, len(x)))  # vector, one, products of entries
        terms[:width], terms[width], at = x.T, 1.0, width + 1
        for i in range(width):
            np.multiply(terms[i], terms[i:width], out=terms[at : at + width - i])
            at += width - i
        p, logs = densities(terms[: width + 1]), []
        for a, b in pairs:
            total = p[a:b].sum(0)
            logs.append(float(weight @ np.log(total)))
            p[a:b] *= weight / total
        return np.concatenate([p.sum(1), (p @ terms[:width].T).ravel(), (p @ terms[width + 1 :].T).ravel(), logs])

    return of


def _maximised(m: Mixture, held: np.ndarray, first: np.ndarray, second: np.ndarray) -> None:
    """New weights, means and covariances from the sums of a pass."""
    d = m.means.shape[1]
    rows, columns = np.triu_indices(d)
    m.weights = held / held.sum()
    m.means = first / held[:, None]
    for i in range(m.k):
        cov = np.zeros((d, d))
        cov[rows, columns] = second[i] / held[i] - (np.outer(m.means[i], m.means[i]))[rows, columns]
        m.covariances[i] = cov + np.triu(cov, 1).T


def fit_mixtures(blocks: Blocks, mixtures: Sequence[Mixture], max_iter: int = 100, tol: float = 0.01) -> dict[int, str]:
    """Runs EM rounds for all ``mixtures`` together until each has settled or had ``max_iter`` rounds, each
    round one pass over the blocks; returns the reason of every k that could not go on."""
    failed: dict[int, str] = {}
    d = blocks.width

    def usable(m: Mixture) -> bool:
        try:
            m.densities()
        except NoSpread as err:
            failed[m.k] = str(err)
        return m.k not in failed

    running = [m for m in mixtures if usable(m)]
    for _ in range(max_iter):
        if not running:
            break
        sums = blocks.sums(_expectation(running))
        n, at = sum(m.k for m in running), 0
        first, second = sums[n : n + n * d].reshape(n, d), sums[n + n * d : -len(running)].reshape(n, -1)
        for m, value in zip(running, sums[-len(running) :]):
            _maximised(m, sums[at : at + m.k], first[at : at + m.k], second[at : at + m.k])
            m.history.append(float(value))
            m.rounds, at = m.rounds + 1, at + m.k
        settled = [len(m.history) > 1 and abs(m.history[-1] - m.history[-2]) <= tol for m in running]
        for m in running:
            m.log_likelihood = m.history[-1]
        running = [m for m, done in zip(running, settled) if usable(m) and not done]
    return failed


def mixture_model(spark, m: Mixture, features: str, seed: int, max_iter: int, tol: float) -> GaussianMixtureModel:
    """Spark's model of a fitted mixture."""
    sc = spark.sparkContext
    gaussian = sc._jvm.org.apache.spark.ml.stat.distribution.MultivariateGaussian
    weights, parts = sc._gateway.new_array(sc._jvm.double, m.k), sc._gateway.new_array(gaussian, m.k)
    d = m.means.shape[1]
    for i in range(m.k):
        weights[i] = float(m.weights[i])
        parts[i] = gaussian(_py2java(sc, DenseVector(m.means[i])), _py2java(sc, DenseMatrix(d, d, m.covariances[i].ravel(order="F").tolist())))
    estimator = GaussianMixture(k=m.k, seed=seed, featuresCol=features, maxIter=max_iter, tol=tol)
    java = sc._jvm.org.apache.spark.ml.clustering.GaussianMixtureModel(estimator.uid, weights, parts)
    return estimator._copyValues(GaussianMixtureModel(java))


# --------------------------------------------------------------------------- k-means


def start_centres(df: DataFrame, features: str, k: int, seed: int, weight: str | None = None) -> np.ndarray:
    """The centres from which Spark's estimator starts (k-means||): a fit of no rounds."""
    weighted = {"weightCol": weight} if weight else {}
    model = KMeans(k=k, seed=seed, featuresCol=features, maxIter=0, solver="block", **weighted).fit(df)
    return np.array(model.clusterCenters())


def _nearest(centres: Sequence[np.ndarray]) -> Callable[[np.ndarray], list[np.ndarray]]:
    """For vectors, the number of the nearest centre in each set of centres (of equal ones the first)."""
    every, cuts = np.concatenate(centres), np.cumsum([0, *map(len, centres)])
    middle = every.mean(0)  # distances from here: no digits are lost to an offset that all rows share
    apart = every - middle
    norms = (apart * apart).sum(1)[:, None]

    def of(x: np.ndarray) -> list[np.ndarray]:
        far = norms - 2 * (apart @ (x - middle).T)
        return [far[a:b].argmin(0) for a, b in zip(cuts[:-1], cuts[1:])]

    return of


def fit_kmeans(blocks: Blocks, starts: Sequence[np.ndarray], max_iter: int = 20, tol: float = 1e-4) -> list[np.ndarray]:
    """Lloyd rounds from every set of centres together, one pass over the blocks each, until no centre of
    a set moves by more than ``tol`` or it had ``max_iter`` rounds. A centre without rows stays."""
    centres, running = [np.array(c, float) for c in starts], list(range(len(starts)))
    for _ in range(max_iter):
        if not running:
            break
        nearest, ks = _nearest([centres[i] for i in running]), [len(centres[i]) for i in running]

        def of(x: np.ndarray, weight: np.ndarray) -> np.ndarray:
            rows = np.column_stack([weight, weight[:, None] * x])
            return np.concatenate([(label == np.arange(k)[:, None]).astype(float) @ rows for label, k in zip(nearest(x), ks)]).ravel()

        sums, at, moving = blocks.sums(of).reshape(sum(ks), -1), 0, []
        for i, k in zip(running, ks):
            held, total, at = sums[at : at + k, :1], sums[at : at + k, 1:], at + k
            new = np.where(held > 0, total / np.where(held > 0, held, 1.0), centres[i])
            if (((new - centres[i]) ** 2).sum(1) > tol * tol).any():
                moving.append(i)
            centres[i] = new
        running = moving
    return centres


def kmeans_model(spark, centres: np.ndarray, k: int, features: str, seed: int, max_iter: int, tol: float,
                 weight: str | None = None) -> KMeansModel:
    """Spark's model of fitted centres."""
    sc = spark.sparkContext
    rows = sc._jvm.java.util.ArrayList()
    for row in centres:
        rows.add(sc._jvm.org.apache.spark.mllib.linalg.Vectors.fromML(_py2java(sc, DenseVector(row))))
    estimator = KMeans(k=k, seed=seed, featuresCol=features, maxIter=max_iter, tol=tol, **({"weightCol": weight} if weight else {}))
    java = sc._jvm.org.apache.spark.ml.clustering.KMeansModel(estimator.uid, sc._jvm.org.apache.spark.mllib.clustering.KMeansModel(rows))
    return estimator._copyValues(KMeansModel(java))


# --------------------------------------------------------------------------- silhouettes


def _cluster_sums(labels: Sequence[np.ndarray], ks: Sequence[int], x: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """(weight, weighted squared norm, weighted vector) of every cluster of every candidate."""
    rows = np.column_stack([weight, weight * (x * x).sum(1), weight[:, None] * x])
    return np.concatenate([(label == np.arange(k)[:, None]).astype(float) @ rows for label, k in zip(labels, ks)]).ravel()


def _row_silhouettes(label: np.ndarray, held: np.ndarray, norms: np.ndarray, sums: np.ndarray, x: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Squared-Euclidean silhouette of every row under one candidate."""
    with np.errstate(divide="ignore", invalid="ignore"):
        far = (x * x).sum(1)[:, None] + norms / held - 2 * (x @ sums.T) / held
        far[:, held <= 0] = np.inf
        at = np.arange(len(x))
        rest = held[label] - weight
        own = far[at, label] * held[label] / rest
        far[at, label] = np.inf
        other = far.min(1)
        s = np.where(own < other, 1 - own / other, np.where(own > other, other / own - 1, 0.0))
    return np.where(rest <= 0, 0.0, s)


def _all_silhouettes(blocks: Blocks, split: Callable, ks: Sequence[int]) -> list[float | None]:
    """Mean silhouette of every candidate (None: a single cluster is in use), two passes for all.
    ``split(rows)`` gives the cluster numbers under each candidate and the vectors."""

    def clusters(rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
        labels, x = split(rows)
        return _cluster_sums(labels, ks, x, weight)

    sums, cuts = blocks.sums(clusters).reshape(sum(ks), -1), np.cumsum([0, *ks])
    parts = [sums[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def of(rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
        labels, x = split(rows)
        each = [_row_silhouettes(label, p[:, 0], p[:, 1], p[:, 2:], x, weight) for label, p in zip(labels, parts)]
        return np.array([weight @ s for s in each] + [weight.sum()])

    got = blocks.sums(of)
    return [float(s / got[-1]) if (p[:, 0] > 0).sum() > 1 else None for s, p in zip(got[:-1], parts)]


def mixture_silhouettes(blocks: Blocks, mixtures: Sequence[Mixture]) -> list[float | None]:
    """M7 for the hard assignment of every mixture."""
    densities = _Densities(mixtures)
    pairs = list(zip(densities.cuts[:-1], densities.cuts[1:]))

    def split(x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        p = densities(np.vstack([x.T, np.ones(len(x))]))
        return [p[a:b].argmax(0) for a, b in pairs], x

    return _all_silhouettes(blocks, split, [m.k for m in mixtures])


def kmeans_silhouettes(blocks: Blocks, centres: Sequence[np.ndarray]) -> list[float | None]:
    """M7 for the nearest of every set of centres."""
    nearest = _nearest(centres)
    return _all_silhouettes(blocks, lambda x: (nearest(x), x), [len(c) for c in centres])


def silhouettes(scored: DataFrame, predictions: Sequence[str], features: str = "features", weight: str | None = None) -> list[float | None]:
    """M7 of several clusterings of the same rows, one column of cluster numbers (from 0) each: the mean
    squared-Euclidean silhouette of each, ``None`` where a single cluster is used."""
    n = len(predictions)
    most = scored.agg(*[F.max(F.col(f"`{c}`")).cast("int").alias(f"m{i}") for i, c in enumerate(predictions)]).first()
    with packed(scored, features, weight, predictions) as blocks:
        return _all_silhouettes(blocks, lambda rows: (list(rows[:, :n].T.astype(int)), rows[:, n:]), [m + 1 for m in most])
