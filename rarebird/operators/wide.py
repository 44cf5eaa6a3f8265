"""Feature preparation for widths that the driver cannot hold squared or label by label.

Spark's indexer gathers every category on the driver, its encoder and assembler name every slot there,
and its PCA keeps a d x d covariance. Here the same features come without any of that:

* ``rank_labels`` counts the categories and ranks them by a range-partitioned sort: a label's index is
  its place in its partition plus the labels before that partition. Labels stay in a table; only a
  count per partition and column reaches the driver.
* ``WideAssembler`` encodes by joins with that table and builds sparse vectors. Labels are ranked by
  frequency, so the first ones, a bounded number of bounded size, are broadcast, and what is left
  for the shuffled join has no hot value by construction.
* ``BlockPCA`` finds the leading components by distributed products of the covariance with blocks of
  vectors (a thick-restarted block Krylov iteration): d x (a few k) on the driver, never d x d, and
  rows are centred in the product, so sparse vectors stay sparse.

All three are pipeline stages; fitted ones save and load with the pipeline that holds them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.common import _py2java
from pyspark.ml.feature import PCA, PCAModel, StandardScaler, StandardScalerModel
from pyspark.ml.linalg import DenseMatrix, DenseVector, VectorUDT
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarebird.functions.columns import vector_parts
from rarebird.session import remove_at_exit, remove_path, scratch_path

#: labels of one column that are broadcast at most, and their bytes
HEAD_LABELS = 10_000
HEAD_BYTES = 8 << 20
#: width up to which a covariance is taken whole
SMALL_WIDTH = 64
_SPREAD = 1 << 16


# --------------------------------------------------------------------------- labels


def label_order(value: Column) -> Column:
    """The order of Java strings (UTF-16 units), in which the indexer breaks ties."""
    return F.encode(value, "UTF-16BE")


def rank_labels(df: DataFrame, categorical: Sequence[str], where: str) -> dict[str, int]:
    """F1 as a table: writes ``column_id, label, row_count, category_index`` of every category to the
    folder ``where`` and returns the number of labels of each column.

    Order as the indexer's: frequency descending, then the label as text. Nulls are no labels. The
    counts are combined before the shuffle, so a hot value sends one row a task.
    """
    spark, cats = df.sparkSession, list(categorical)
    values = [F.struct(F.lit(i).alias("column_id"), F.col(f"`{c}`").cast("string").alias("label")) for i, c in enumerate(cats)]
    counted = df.select(F.explode(F.array(*values)).alias("x")).select("x.*").where("label is not null").groupBy(
        "column_id", "label").agg(F.count(F.lit(1)).alias("row_count"))
    order = [F.col("column_id"), F.col("row_count").desc(), label_order(F.col("label"))]
    placed = counted.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    sorted_at = f"{where}-sorted"
    placed.write.mode("overwrite").parquet(sorted_at)
    placed = spark.read.schema(placed.schema).parquet(sorted_at)
    part = F.shiftright("place", 33)
    # one row per partition and column
    parts = placed.groupBy("column_id", part.alias("part")).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).collect()
    sizes, shifts = {c: 0 for c in cats}, []
    for row in sorted(parts, key=lambda r: (r["column_id"], r["part"])):
        shifts.append((row["column_id"], row["part"], sizes[cats[row["column_id"]]] - row["first"]))
        sizes[cats[row["column_id"]]] += row["n"]
    shift = spark.createDataFrame(shifts, "column_id int, part long, shift long")
    ranked = placed.withColumn("part", part).join(F.broadcast(shift), ["column_id", "part"]).select(
        "column_id", "label", "row_count", (F.col("place") + F.col("shift")).alias("category_index"))
    ranked.write.mode("overwrite").partitionBy("column_id").parquet(where)
    remove_path(spark, sorted_at)
    return sizes


def category_table(df: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """F1 as a frame: ``column_name, label, row_count, category_index``, labels ranked without a gather."""
    spark, where = df.sparkSession, scratch_path(df.sparkSession, "labels")
    rank_labels(df, categorical, where)
    remove_at_exit(spark, where)
    names = F.array(*[F.lit(c) for c in categorical])
    return _read_labels(spark, where).select(
        F.get(names, F.col("column_id")).alias("column_name"), "label", "row_count", "category_index")


def _read_labels(spark: SparkSession, where: str) -> DataFrame:
    return spark.read.schema("label string, row_count long, category_index long, column_id int").parquet(where)


def _lookup(df: DataFrame, labels: DataFrame, column: str, head: int, size: int, into: str) -> DataFrame:
    """``df`` with the index of ``column`` (null: unseen). The ``head`` most frequent labels are
    broadcast; only rows with a rarer value meet the rest in a shuffled join, the others are spread by a
    hash of the row and match nothing there."""
    key = F.col(f"`{column}`").cast("string")
    first = labels.where(F.col("category_index") < head).select(F.col("label").alias("__label"), F.col("category_index").alias(into))
    out = df.join(F.broadcast(first), key == F.col("__label"), "left").drop("__label")
    if size <= head:
        return out
    found = F.col(into).isNotNull()
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    out = out.select("*", F.when(found, F.lit(None)).otherwise(key).alias("__key"),
                     F.when(found, F.pmod(F.xxhash64(*hashable), F.lit(_SPREAD)) + 1).otherwise(F.lit(0)).alias("__salt"))
    rest = labels.where(F.col("category_index") >= head).select(
        F.col("label").alias("__key"), F.lit(0).cast("long").alias("__salt"), F.col("category_index").alias("__rest"))
    out = out.withColumn("__salt", F.col("__salt").cast("long")).join(rest, ["__key", "__salt"], "left")
    return out.withColumn(into, F.coalesce(into, "__rest")).drop("__key", "__salt", "__rest")


# --------------------------------------------------------------------------- sparse vectors


class WideAssembler(Estimator):
    """F1-F3 / F8 in one stage: numeric columns in order, then one slot per seen label of each
    categorical column, as sparse vectors in ``output``. Unseen labels and nulls encode as zeros."""

    def __init__(self, numeric: Sequence[str], categorical: Sequence[str], output: str):
        super().__init__()
        self.numeric, self.categorical, self.output = list(numeric), list(categorical), output

    def _fit(self, dataset: DataFrame) -> "WideAssemblerModel":
        spark = dataset.sparkSession
        where = scratch_path(spark, "labels")
        sizes = rank_labels(dataset, self.categorical, where) if self.categorical else {}
        remove_at_exit(spark, where)
        return WideAssemblerModel(self.numeric, self.categorical, self.output, sizes, _heads(spark, where, sizes, self.categorical), where)


def _heads(spark: SparkSession, where: str, sizes: dict[str, int], categorical: Sequence[str]) -> dict[str, int]:
    """How many labels of each column may be broadcast: HEAD_LABELS, fewer when they are long."""
    if not sizes:
        return {}
    longest = {r["column_id"]: r["m"] for r in _read_labels(spark, where).where(F.col("category_index") < HEAD_LABELS).groupBy(
        "column_id").agg(F.max(F.octet_length("label")).alias("m")).collect()}
    return {c: min(HEAD_LABELS, HEAD_BYTES // max(longest.get(i) or 1, 1)) for i, c in enumerate(categorical)}


class WideAssemblerModel(Model, MLWritable, MLReadable):
    """The label table (a Parquet folder) and the layout of the slots."""

    def __init__(self, numeric: Sequence[str] = (), categorical: Sequence[str] = (), output: str = "", sizes: dict[str, int] | None = None,
                 heads: dict[str, int] | None = None, where: str = ""):
        super().__init__()
        self.numeric, self.categorical, self.output = list(numeric), list(categorical), output
        self.sizes, self.heads, self.where = dict(sizes or {}), dict(heads or {}), where

    @property
    def width(self) -> int:
        return len(self.numeric) + sum(self.sizes.values())

    def indexes(self, df: DataFrame) -> DataFrame:
        """``df`` with one column ``__index_<i>`` (null: unseen) per categorical column."""
        for i, c in enumerate(self.categorical):
            labels = _read_labels(df.sparkSession, self.where).where(F.col("column_id") == i)
            df = _lookup(df, labels, c, self.heads[c], self.sizes[c], f"__index_{i}")
        return df

    def _transform(self, dataset: DataFrame) -> DataFrame:
        vectors = [f.name for f in dataset.schema.fields if f.name in self.numeric and not isinstance(f.dataType, (T.NumericType, T.BooleanType))]
        if vectors:
            raise ValueError(f"columns {vectors} are not numbers")
        carried, types = dataset.columns, [dataset.schema[c].dataType for c in dataset.columns]
        wide = self.indexes(dataset).select(
            *[F.col(f"`{c}`") for c in carried],
            *[F.col(f"`{c}`").cast("double").alias(f"__number_{i}") for i, c in enumerate(self.numeric)],
            *[F.col(f"__index_{i}") for i in range(len(self.categorical))])
        n, width, output = len(self.numeric), self.width, self.output
        starts = (n + np.concatenate([[0], np.cumsum([self.sizes[c] for c in self.categorical])])[:-1]).astype(np.int64) if self.categorical else []
        first = len(carried)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = batch.num_rows
                numbers = [batch.column(first + i) for i in range(n)]
                if any(c.null_count for c in numbers):
                    raise ValueError("null in a numeric column: drop incomplete rows first")
                slots = np.tile(np.arange(n + len(starts)), (rows, 1))
                values = np.ones((rows, n + len(starts)))
                for i, c in enumerate(numbers):
                    values[:, i] = c.to_numpy(zero_copy_only=False)
                for i, start in enumerate(starts):
                    at = batch.column(first + n + i).fill_null(-1).to_numpy(zero_copy_only=False)
                    slots[:, n + i] = np.where(at < 0, -1, at + start)
                held = (slots >= 0) & (values != 0)
                offsets = pa.array(np.concatenate([[0], held.sum(1).cumsum()]).astype(np.int32))
                vector = pa.StructArray.from_arrays([
                    pa.array(np.zeros(rows, np.int8)), pa.array(np.full(rows, width, np.int32)),
                    pa.ListArray.from_arrays(offsets, pa.array(slots[held].astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(values[held]))], names=["type", "size", "indices", "values"])
                yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(first)] + [vector], names=[*carried, output])

        schema = T.StructType([T.StructField(c, t) for c, t in zip(carried, types)] + [T.StructField(output, VectorUDT())])
        return wide.mapInArrow(run, schema)

    def write(self) -> MLWriter:
        return _WideWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _WideReader()


class _WideWriter(MLWriter):
    def __init__(self, model: WideAssemblerModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        layout = {"numeric": m.numeric, "categorical": m.categorical, "output": m.output, "sizes": m.sizes, "heads": m.heads}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={"layout": json.dumps(layout)})
        if m.categorical:
            _read_labels(self.sparkSession, m.where).write.partitionBy("column_id").parquet(f"{path}/labels")


class _WideReader(MLReader):
    def load(self, path: str) -> WideAssemblerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = WideAssemblerModel(**json.loads(metadata["layout"]), where=f"{path}/labels")
        model._resetUid(metadata["uid"])
        return model


# --------------------------------------------------------------------------- components


def _rows(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Row, slot and value of every held entry of a column of ML vectors, and the number of rows."""
    kind, values, slots = column.field("type").to_numpy(zero_copy_only=False), column.field("values"), column.field("indices")
    lengths = np.diff(values.offsets.to_numpy())
    row = np.repeat(np.arange(len(column)), lengths)
    if (kind == 1).all():
        slot = np.tile(np.arange(width), len(column))
    else:
        slot = np.empty(len(row), np.int64)
        dense = kind[row] == 1
        slot[dense] = np.tile(np.arange(width), int((kind == 1).sum()))
        slot[~dense] = slots.flatten().to_numpy(zero_copy_only=False)
    return row, slot, values.flatten().to_numpy(zero_copy_only=False), len(column)


def _scatter(at: np.ndarray, what: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows of ``what`` by ``at``."""
    return np.stack([np.bincount(at, what[:, c], size) for c in range(what.shape[1])], axis=1)


def _slices(column: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray | None]]:
    """(first row, end, matrix) of slices of a column of ML vectors that hold at most ``_SLICE_CELLS``
    entries (one row at least); the matrix of dense rows is a view, and ``None`` where a row is sparse."""
    values = column.field("values")
    held = values.offsets.to_numpy()
    dense = bool((column.field("type").to_numpy(zero_copy_only=False) == 1).all())
    flat, start = values.flatten().to_numpy(zero_copy_only=False), 0
    while start < len(column):
        end = int(np.searchsorted(held, held[start] + _SLICE_CELLS, side="right")) - 1
        end = min(max(end, start + 1), len(column))
        yield start, end, flat[held[start] - held[0] : held[end] - held[0]].reshape(end - start, width) if dense else None
        start = end


#: numbers a task holds before it hands its sums on, and entries that one step of it works on
_TASK_CELLS = 4 << 20
_SLICE_CELLS = 1 << 20


def _summed(frame: DataFrame, width: int, columns: int, weighted: bool, of, dense_of, extra: int = 0) -> np.ndarray:
    """A (width + extra) x columns matrix: the sum over all rows of what ``of(row, slot, value, rows, weight)``
    gives as (slots, matrix) for sparse rows, and ``dense_of(matrix, weight)`` as a whole matrix for dense ones.
    Tasks pre-aggregate; sums are shuffled by slot."""
    height = width + extra

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(slots: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int64))] + [pa.array(np.ascontiguousarray(sums[:, c])) for c in range(columns)],
                                              names=["slot"] + [f"y{c}" for c in range(columns)])

        total = np.zeros((height, columns)) if height * columns <= _TASK_CELLS else None
        for batch in batches:
            weight = batch.column(1).to_numpy(zero_copy_only=False).astype(float) if weighted else np.ones(batch.num_rows)
            for start, end, matrix in _slices(batch.column(0), width):
                if matrix is not None:
                    slots, sums = slice(None), dense_of(matrix, weight[start:end])
                else:
                    slots, sums = of(*_rows(batch.column(0).slice(start, end - start), width), weight[start:end])
                if total is not None:
                    total[slots] += sums
                else:
                    yield packed(np.arange(height)[slots], sums)
        if total is not None:
            held = np.flatnonzero(np.abs(total).sum(1))
            yield packed(held, total[held])

    schema = "slot long, " + ", ".join(f"y{c} double" for c in range(columns))
    vectors, *weights = frame.columns
    parts = frame.select(vector_parts(vectors).alias("vector"), *weights).mapInArrow(run, schema)
    got = parts.groupBy("slot").agg(*[F.sum(f"y{c}").alias(f"y{c}") for c in range(columns)]).toArrow()
    out = np.zeros((height, columns))
    at = got.column("slot").to_numpy()
    for c in range(columns):
        out[at, c] = got.column(f"y{c}").to_numpy()
    return out


def slot_moments(frame: DataFrame, width: int, weighted: bool = False) -> tuple[float, np.ndarray, np.ndarray]:
    """Total weight, and the weighted mean and sample variance of every slot, of a frame of vectors
    (and weights): one pass."""

    def of(row, slot, value, rows, weight):
        slots, place = np.unique(slot, return_inverse=True)
        w = weight[row]
        return slots, _scatter(place, np.stack([w * value, w * value * value], axis=1), len(slots))

    def dense_of(x, weight):
        return np.stack([weight @ x, weight @ (x * x)], axis=1)

    weight = F.sum(F.col(frame.columns[1]).cast("double")) if weighted else F.count(F.lit(1)).cast("double")
    n = float(frame.agg(weight.alias("n")).first()["n"] or 0.0)
    sums = _summed(frame, width, 2, weighted, of, dense_of)
    mean = sums[:, 0] / max(n, 1.0)
    return n, mean, np.maximum(sums[:, 1] - n * mean * mean, 0.0) / max(n - 1.0, 1.0)


def covariance_times(frame: DataFrame, mean: np.ndarray, n: float, block: np.ndarray, weighted: bool = False) -> np.ndarray:
    """The sample covariance times a block of vectors, without the covariance: rows are projected and
    centred, and the projections summed back over the rows' entries, in one pass."""
    width, columns = block.shape
    middle = mean @ block

    def of(row, slot, value, rows, weight):
        projected = _scatter(row, value[:, None] * block[slot], rows) - middle
        projected *= weight[:, None]
        slots, place = np.unique(np.append(slot, width), return_inverse=True)
        what = np.vstack([value[:, None] * projected[row], projected.sum(0)])
        return slots, _scatter(place, what, len(slots))

    def dense_of(x, weight):
        projected = (x @ block - middle) * weight[:, None]
        return np.vstack([x.T @ projected, projected.sum(0)])

    # slot `width` holds the sum of the projections: 0 but for rounding, which it corrects
    sums = _summed(frame, width, columns, weighted, of, dense_of, extra=1)
    return (sums[:width] - np.outer(mean, sums[width])) / max(n - 1.0, 1.0)


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to the columns of ``against``."""
    scale = np.linalg.norm(block, axis=0)
    block = block[:, scale > 0] / scale[scale > 0]
    for _ in range(2):
        block = block - against @ (against.T @ block)
        norms = np.linalg.norm(block, axis=0)
        block = block[:, norms > 1e-8] / norms[norms > 1e-8]
    if not block.shape[1]:
        return block
    q, r = np.linalg.qr(block)
    q = q[:, np.abs(np.diag(r)) > 1e-8]
    return q - against @ (against.T @ q)


def leading_components(product, width: int, k: int, tol: float = 1e-10, max_passes: int = 200, seed: int = 7,
                       spare: int = 6, blocks: int = 5) -> tuple[np.ndarray, np.ndarray, int]:
    """The ``k`` largest eigenvalues and their vectors (columns) of a symmetric matrix known by
    ``product(block)`` only, and the number of products taken.

    A block Krylov iteration with Rayleigh-Ritz: the basis grows by the residuals of the leading
    ``k + spare`` approximations and restarts from those when it holds ``blocks`` blocks. It ends when
    every residual of the first ``k`` is at most ``tol`` times the largest eigenvalue.
    """
    size = min(width, k + spare)
    basis, images = np.zeros((width, 0)), np.zeros((width, 0))
    added = _orthonormal(np.random.default_rng(seed).standard_normal((width, size)), basis)
    for passes in range(1, max_passes + 1):
        basis, images = np.hstack([basis, added]), np.hstack([images, product(added)])
        small = basis.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1][:size], turn[:, ::-1][:, :size]
        vectors, turned = basis @ turn, images @ turn
        residual = turned - vectors * values
        if (np.linalg.norm(residual[:, :k], axis=0) <= tol * max(abs(values[0]), 1e-300)).all():
            return values[:k], vectors[:, :k], passes
        if basis.shape[1] + size > max(blocks * size, 2 * size) and basis.shape[1] < width:
            basis, images = vectors, turned
        added = _orthonormal(residual, basis)
        if not added.shape[1]:
            return values[:k], vectors[:, :k], passes
    raise RuntimeError(f"the components did not settle in {max_passes} passes")


def standardizer(frame: DataFrame, width: int, input_col: str, output_col: str, weight: str, centre: bool) -> StandardScalerModel:
    """F5 / F6 by weighted rows: Spark's scaler model with the mean and deviation of the rows repeated by
    their whole-number weights. Spark's own estimator takes no weights."""
    _, mean, variance = slot_moments(frame.select(input_col, weight), width, weighted=True)
    sc = frame.sparkSession.sparkContext
    estimator = StandardScaler(inputCol=input_col, outputCol=output_col, withStd=True, withMean=centre)
    java = sc._jvm.org.apache.spark.ml.feature.StandardScalerModel(
        estimator.uid, _py2java(sc, DenseVector(np.sqrt(variance))), _py2java(sc, DenseVector(mean)))
    return estimator._copyValues(StandardScalerModel(java))


class BlockPCA(Estimator):
    """F7 for any width: Spark's ``PCAModel``, fitted by distributed products (no d x d matrix).

    As with Spark's PCA the components are learned on centred data and ``transform`` does not centre.
    ``weight`` names a column of row weights. The input is written to the shared scratch folder first,
    so passes re-read vectors instead of repeating the stages before; ``passes`` tells how many there were.
    """

    def __init__(self, k: int, input_col: str, output_col: str, weight: str | None = None, tol: float = 1e-10, max_passes: int = 200):
        super().__init__()
        self.k, self.input_col, self.output_col, self.weight = k, input_col, output_col, weight
        self.tol, self.max_passes, self.passes = tol, max_passes, 0

    def _fit(self, dataset: DataFrame) -> PCAModel:
        spark = dataset.sparkSession
        picked = dataset.select(self.input_col, *([self.weight] if self.weight else []))
        where = scratch_path(spark, "pca")
        try:
            picked.write.parquet(where)
            frame = spark.read.schema(picked.schema).parquet(where)
            values, vectors, total = self._components(frame)
        finally:
            remove_path(spark, where)
        signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(self.k)])
        vectors = vectors * np.where(signs == 0, 1.0, signs)
        explained = np.maximum(values, 0.0) / total if total > 0 else np.zeros(self.k)
        sc = spark.sparkContext
        java = sc._jvm.org.apache.spark.ml.feature.PCAModel(
            self.uid, _py2java(sc, DenseMatrix(len(vectors), self.k, vectors.ravel(order="F").tolist())), _py2java(sc, DenseVector(explained)))
        return PCA(k=self.k, inputCol=self.input_col, outputCol=self.output_col)._copyValues(PCAModel(java))

    def _components(self, frame: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
        first = frame.select(self.input_col).first()
        if first is None:
            raise ValueError("components of an empty frame")
        width, weighted = first[0].size, self.weight is not None
        if self.k > width:
            raise ValueError(f"{self.k} components of {width} columns")
        n, mean, variance = slot_moments(frame, width, weighted)
        if width <= SMALL_WIDTH:  # the whole matrix in one product
            self.passes = 1
            square = covariance_times(frame, mean, n, np.eye(width), weighted)
            values, vectors = np.linalg.eigh((square + square.T) / 2)
            return values[::-1][: self.k], vectors[:, ::-1][:, : self.k], float(variance.sum())
        values, vectors, self.passes = leading_components(
            lambda block: covariance_times(frame, mean, n, block, weighted), width, self.k, self.tol, self.max_passes)
        return values, vectors, float(variance.sum())
