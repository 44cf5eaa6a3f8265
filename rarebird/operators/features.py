"""Feature preparation.

A table with an id column, zero or more categorical columns and numeric columns becomes one
vector column. Categorical columns are indexed by frequency and one-hot encoded (unseen
values encode as all zeros), numeric columns are taken in frame order with the category
vectors appended, then the vector is standardized and, optionally, reduced by PCA.

Every stage is a Spark ML estimator: fitting costs one distributed pass per stage (the labels of
all categorical columns are counted once, for the indexer and the width), and scoring is a narrow,
shuffle-free projection. A preparation wider than the driver can hold (labels, slots, a d x d
covariance) takes the stages of :mod:`rarebird.operators.wide` instead, which give the same features.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, OneHotEncoder, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarebird.operators.layout import spread_rows
from rarebird.operators.wide import BlockPCA, WideAssembler

INDEX_SUFFIX = "_index"
ONEHOT_SUFFIX = "_onehot"
RAW = "raw_features"
SCALED = "scaled_features"
FEATURES = "features"

_UNCENTRED = "uncentred_components"
_SUPERVISED = "__supervised_vector"

SCALE_CENTRED = "centred"
SCALE_ONLY = "scale_only"


def parse_columns(text: str | Sequence[str] | None) -> list[str]:
    """``"a,b"`` -> ``["a", "b"]``; ``""``, ``None`` or ``[""]`` -> no columns."""
    if text is None:
        return []
    items = text.split(",") if isinstance(text, str) else list(text)
    return [c.strip() for c in items if c and c.strip()]


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop every row with a null (or NaN, for floating columns) in any column.

    Same rows as ``na.drop("any")``, written as one conjunction of per-column tests so that
    ``IS NOT NULL`` reaches the Parquet scan as pushed filters. Select the needed columns
    *before* calling this so the scan stays pruned.
    """
    cols = list(subset) if subset else df.columns
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    cond = None
    for c in cols:
        ok = F.col(c).isNotNull()
        if isinstance(types[c], (T.DoubleType, T.FloatType)):
            ok = ok & ~F.isnan(F.col(c))
        cond = ok if cond is None else cond & ok
    return df if cond is None else df.filter(cond)


def split_roles(
    columns: Sequence[str], categorical: Sequence[str] | str | None, id_col: str | None = None
) -> tuple[list[str], list[str]]:
    """P5: (numeric, categorical). Numeric = every column that is neither the id nor
    categorical, in frame order."""
    cats = parse_columns(categorical)
    numeric = [c for c in columns if c not in cats and c != id_col]
    return numeric, cats


#: bytes the driver holds per feature column: a scaler's or a centre's doubles and a category's label
_COLUMN_BYTES = 4096


def label_counts(df: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """``c, v, n``: the number of rows of every value (as text, without null) of the ``c``-th categorical
    column. Every column is grouped by itself, so of a cached frame each is read alone."""
    out = None
    for i, c in enumerate(categorical):
        values = df.select(F.lit(i).alias("c"), F.col(f"`{c}`").cast("string").alias("v")).where("v is not null")
        counted = values.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
        out = counted if out is None else out.unionAll(counted)
    return out


def category_counts(df: DataFrame, categorical: Sequence[str]) -> dict[str, int]:
    """Exact number of distinct values of each categorical column, combined before the shuffle, one row
    per column back."""
    cats = list(categorical)
    return _distinct(label_counts(df, cats), cats) if cats else {}


def _distinct(labels: DataFrame, cats: Sequence[str]) -> dict[str, int]:
    counts = {cats[r["c"]]: int(r["count"]) for r in labels.groupBy("c").count().collect()}
    return {c: counts.get(c, 0) for c in cats}


def driver_memory(df: DataFrame) -> int:
    """Bytes of the driver's heap."""
    return int(df.sparkSession.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory())


class TooWide(ValueError):
    """More feature columns than the limit."""


def check_width(df: DataFrame, stages: Sequence, max_width: int | None = None, square: bool | None = None,
                labels: DataFrame | None = None) -> int:
    """The exact feature width that ``stages`` produce before scaling; refuses a wider one than fits.

    The indexer gathers every category on the driver, and fits hold d x d matrices there (a PCA, or a
    mixture's covariances: ``square``, by default whether a PCA is among the stages). ``max_width`` is
    the caller's limit; without one it is what a quarter of the driver's memory holds: three d x d
    matrices of doubles, or 4 KB a column where nothing is d x d. ``labels`` are the indexer's
    :func:`label_counts`, if they are there already.
    """
    cats = _indexed_columns(stages)
    assemblers = [s for s in stages if isinstance(s, VectorAssembler)]
    counts = category_counts(df, cats) if labels is None else _distinct(labels, cats)
    inputs = assemblers[0].getInputCols() if assemblers else []
    width = sum(1 for c in inputs if not c.endswith(ONEHOT_SUFFIX)) + sum(counts.values())
    if max_width is None:
        square = any(isinstance(s, PCA) for s in stages) if square is None else square
        budget = driver_memory(df) // 4
        max_width = int((budget / 24) ** 0.5) if square else budget // _COLUMN_BYTES
    if width > max_width:
        raise TooWide(f"{width} feature columns, the limit is {max_width} (max_width, or more driver memory); "
                         f"categories by column: {counts}")
    return width


def _indexed_columns(stages: Sequence) -> list[str]:
    indexers = [s for s in stages if isinstance(s, StringIndexer)]
    return list(indexers[0].getInputCols()) if indexers else []


def _fitted_indexer(indexer: StringIndexer, labels: DataFrame) -> StringIndexer | StringIndexerModel:
    """The indexer's model from the counts of its labels, which Spark's estimator would take again: the most
    frequent label first, of equally frequent ones the smaller."""
    found: list[list] = [[] for _ in indexer.getInputCols()]
    for row in labels.collect():
        found[row["c"]].append((-row["n"], row["v"]))
    if indexer.getStringOrderType() != "frequencyDesc" or not all(found):
        return indexer
    sc = labels.sparkSession.sparkContext
    new, text = sc._gateway.new_array, sc._jvm.java.lang.String
    arrays = new(text, len(found), 0)
    for i, own in enumerate(found):
        arrays[i] = new(text, len(own))
        for j, (_, value) in enumerate(sorted(own)):
            arrays[i][j] = value
    java = sc._jvm.org.apache.spark.ml.feature.StringIndexerModel(indexer.uid, arrays)
    return indexer._copyValues(StringIndexerModel(java))


def fitting_stages(df: DataFrame, stages: Sequence, max_width: int | None = None, square: bool | None = None,
                   wide: bool | None = None) -> list:
    """The stages to fit: as given where the driver can hold their width, else their wide form.

    A ``max_width`` of the caller's is a limit and refuses more. ``wide`` takes (or refuses) the wide form
    whatever the width. A mixture without a PCA before it (``square`` and no PCA) has no wide form: its
    covariances are d x d in any case. Labels are counted once, for their number and for the indexer, which
    is handed back fitted.
    """
    if wide:
        return widen(stages)
    cats = _indexed_columns(stages)
    labels = label_counts(df, cats).persist(StorageLevel.MEMORY_AND_DISK) if cats else None
    try:
        check_width(df, stages, max_width, square, labels)
        first = next((i for i, s in enumerate(stages) if isinstance(s, StringIndexer)), None)
        return [_fitted_indexer(s, labels) if i == first else s for i, s in enumerate(stages)]
    except TooWide:
        no_form = square and not any(isinstance(s, PCA) for s in stages)
        if wide is False or max_width is not None or no_form:
            raise
        return widen(stages)
    finally:
        if labels is not None:
            labels.unpersist()


def widen(stages: Sequence) -> list:
    """The stages of :func:`preparation_stages` without labels, slots or squares on the driver.

    Vectors stay sparse, so centring is put off: with a PCA it is applied to the components (the same
    numbers), without one it is left out, which moves all rows alike and changes no distance.
    """
    indexers = [s for s in stages if isinstance(s, StringIndexer)]
    cats = indexers[0].getInputCols() if indexers else []
    onehot = {c + ONEHOT_SUFFIX for c in cats}
    out: list = []
    for stage in stages:
        if isinstance(stage, VectorAssembler):
            out.append(WideAssembler([c for c in stage.getInputCols() if c not in onehot], cats, stage.getOutputCol()))
        elif isinstance(stage, StandardScaler):
            out.append(StandardScaler(inputCol=stage.getInputCol(), outputCol=stage.getOutputCol(), withStd=True, withMean=False))
        elif isinstance(stage, PCA):
            centre = any(isinstance(s, StandardScaler) and s.getWithMean() for s in stages)
            out.append(BlockPCA(stage.getK(), stage.getInputCol(), _UNCENTRED if centre else stage.getOutputCol()))
            if centre:
                out.append(StandardScaler(inputCol=_UNCENTRED, outputCol=stage.getOutputCol(), withStd=False, withMean=True))
    return out


def category_indexer(categorical: Sequence[str]) -> StringIndexer:
    """one indexer for all categorical columns.

    Order: frequency descending, ties by value ascending; unseen values get index n. Numeric
    columns are indexed as text, so their ties follow text order ("10" before "2").
    """
    return StringIndexer(
        inputCols=list(categorical),
        outputCols=[c + INDEX_SUFFIX for c in categorical],
        handleInvalid="keep",
        stringOrderType="frequencyDesc",
    )


def one_hot_encoder(categorical: Sequence[str]) -> OneHotEncoder:
    """n slots for n seen values; the extra 'unseen' slot is the dropped one, so unseen
    values encode as all zeros and no seen value loses its slot."""
    return OneHotEncoder(
        inputCols=[c + INDEX_SUFFIX for c in categorical],
        outputCols=[c + ONEHOT_SUFFIX for c in categorical],
        dropLast=True,
    )


def assembler(columns: Sequence[str], output: str = RAW) -> VectorAssembler:
    """numeric / boolean / vector columns into one vector."""
    return VectorAssembler(inputCols=list(columns), outputCol=output)


def standard_scaler(input_col: str = RAW, output: str = SCALED, center: bool = True) -> StandardScaler:
    """F5 (centred) / F6 (scale only); sample standard deviation; constant columns give 0."""
    return StandardScaler(inputCol=input_col, outputCol=output, withStd=True, withMean=center)


def pca(k: int, input_col: str = SCALED, output: str = FEATURES) -> PCA:
    """principal components learned from the covariance (d x d on the driver).

    ``transform`` projects without centring, so feed it centred (scaled) vectors."""
    return PCA(k=k, inputCol=input_col, outputCol=output)


def preparation_stages(
    columns: Sequence[str],
    categorical: Sequence[str] | str | None,
    id_col: str | None = None,
    scale: str | None = SCALE_CENTRED,
    pca_k: int | None = None,
    output: str = FEATURES,
) -> list:
    """F4 (+F5/F6, +F7): indexer, encoder, assembler, then scaler and PCA if asked."""
    numeric, cats = split_roles(columns, categorical, id_col)
    if id_col and id_col in cats:
        raise ValueError(f"the id column {id_col!r} cannot be categorical")
    stages: list = []
    if cats:
        stages += [category_indexer(cats), one_hot_encoder(cats)]
    inputs = numeric + [c + ONEHOT_SUFFIX for c in cats]
    if not inputs:
        raise ValueError("no feature columns: every column is the id")
    steps_after = (1 if scale else 0) + (1 if pca_k else 0)
    stages.append(assembler(inputs, output if steps_after == 0 else RAW))
    if scale:
        if scale not in (SCALE_CENTRED, SCALE_ONLY):
            raise ValueError(f"scale must be {SCALE_CENTRED!r}, {SCALE_ONLY!r} or None")
        stages.append(standard_scaler(RAW, output if not pca_k else SCALED, center=scale == SCALE_CENTRED))
    if pca_k:
        stages.append(pca(pca_k, SCALED if scale else RAW, output))
    return stages


def preparation_pipeline(
    columns: Sequence[str],
    categorical: Sequence[str] | str | None,
    id_col: str | None = None,
    scale: str | None = SCALE_CENTRED,
    pca_k: int | None = None,
    output: str = FEATURES,
) -> Pipeline:
    return Pipeline(stages=preparation_stages(columns, categorical, id_col, scale, pca_k, output))


def _fit_once(stages: Sequence, df: DataFrame, max_width: int | None, wide: bool | None = None) -> PipelineModel:
    own = not df.is_cached
    source = df.persist(StorageLevel.MEMORY_AND_DISK) if own else df
    try:
        return Pipeline(stages=fitting_stages(source, stages, max_width, wide=wide)).fit(source)
    finally:
        if own:
            source.unpersist()


@dataclass
class Prepared:
    """A fitted preparation and the frame it produced (``[id,] features``)."""

    model: PipelineModel
    frame: DataFrame


def prepare(
    df: DataFrame,
    categorical: Sequence[str] | str | None,
    id_col: str | None = None,
    scale: str | None = SCALE_CENTRED,
    pca_k: int | None = None,
    output: str = FEATURES,
    max_width: int | None = None,
    wide: bool | None = None,
) -> Prepared:
    """Fit F4 (+ scaler, + PCA) on ``df`` and keep ``[id,] features``. The input is persisted while
    the stages are fitted, so all of them share one scan; ``max_width`` and ``wide`` as in
    :func:`fitting_stages`."""
    df = spread_rows(df, 8 * len(df.columns))
    stages = preparation_stages(df.columns, categorical, id_col, scale, pca_k, output)
    model = _fit_once(stages, df, max_width, wide)
    keep = ([id_col] if id_col else []) + [output]
    return Prepared(model, model.transform(df).select(*keep))


def inference_features(
    df: DataFrame,
    categorical: Sequence[str] | str | None,
    id_col: str | None = None,
    output: str = FEATURES,
    max_width: int | None = None,
    wide: bool | None = None,
) -> DataFrame:
    """F8: encoded and assembled features (no scaling), ``[id,] features``."""
    return prepare(df, categorical, id_col, scale=None, pca_k=None, output=output, max_width=max_width, wide=wide).frame


def feature_width(model: PipelineModel, df: DataFrame, output: str = FEATURES) -> int:
    """Width of the produced vector, read from the column metadata (no data pass)."""
    field = model.transform(df.limit(0)).schema[output]
    attrs = field.metadata.get("ml_attr", {})
    if "num_attrs" in attrs:
        return int(attrs["num_attrs"])
    return sum(len(v) for v in attrs.get("attrs", {}).values())


class SupervisedSplit(tuple):
    """(train, test) of one encoded, persisted frame; ``release`` drops that frame from memory."""

    encoded: DataFrame

    def __new__(cls, train: DataFrame, test: DataFrame, encoded: DataFrame):
        split = super().__new__(cls, (train, test))
        split.encoded = encoded
        return split

    def release(self) -> None:
        self.encoded.unpersist()


def prepare_supervised(
    df: DataFrame,
    categorical: Sequence[str] | str | None,
    target: str,
    feature_columns: Sequence[str] | None = None,
    train_fraction: float = 0.7,
    key: str | None = None,
    seed: int | None = None,
    output: str = "X",
    max_width: int | None = None,
) -> SupervisedSplit:
    """encode + assemble every column but the target (or ``feature_columns``) into
    ``output``, keep the target, and split once into disjoint train and test.

    With ``key`` the split is a hash bucket of that column (stable under re-reads and
    repartitioning, see :func:`rarebird.operators.sampling.keyed_split`); otherwise one
    seeded ``randomSplit``. The encoded frame is persisted, so both halves share one scan and one
    encoding; call ``release()`` of the result when done. ``output`` may differ from a feature column by
    case alone (``X`` beside ``x``), but not from the target or the key.
    """
    from rarebird.operators.sampling import keyed_split, random_split

    if output.lower() in {c.lower() for c in (target, key) if c}:
        raise ValueError(f"output {output!r} is the target or the key: choose another name")
    cats = parse_columns(categorical)
    cols = list(feature_columns) if feature_columns else [c for c in df.columns if c != target and c != key]
    stages: list = []
    if cats:
        stages += [category_indexer(cats), one_hot_encoder(cats)]
    numeric = [c for c in cols if c not in cats]
    stages.append(assembler(numeric + [c + ONEHOT_SUFFIX for c in cats], _SUPERVISED))
    encoded = _fit_once(stages, df, max_width).transform(df)
    keep = [F.col(f"`{key}`")] if key else []
    encoded = encoded.select(*keep, F.col(_SUPERVISED).alias(output), F.col(f"`{target}`")).persist(StorageLevel.MEMORY_AND_DISK)
    halves = keyed_split(encoded, key, train_fraction) if key else random_split(encoded, train_fraction, seed)
    return SupervisedSplit(*halves, encoded)
