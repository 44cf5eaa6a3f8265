"""The jobs (E1-E8): anomaly and segment train / predict / bootstrap, and the two composed
training and prediction jobs.

Plan shape of every job:

* the source is read once, incomplete rows dropped, preparation fitted (one pass per stage);
* the feature frame ``[id, features]`` is written once to the shared scratch folder; every candidate k
  is fitted from it, and ``finally`` deletes it;
* scoring is a narrow projection of that frame and is written **once**; the shares
  are then aggregated from the written table, which reads a single column;
* the monitoring rows are k + 2 rows built as DataFrames, appended by column name.

A failing run appends one failure row and re-raises (``on_error="record"`` returns the
report with the error instead, which is how the composed jobs go on to their next step).
"""

from __future__ import annotations

import logging
import random
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rarebird.functions.columns import run_moment
from rarebird.operators import metrics as M
from rarebird.operators.anomaly import DEFAULT_THRESHOLD, FLAG, flag_anomalies, stored_result
from rarebird.operators.clustering import KMEANS, MIXTURE, SHARED_WIDTH, cluster
from rarebird.operators.layout import options_for, spread, spread_rows
from rarebird.operators.enrich import enrich_and_dedupe
from rarebird.operators.features import (
    FEATURES,
    RAW,
    SCALE_CENTRED,
    SCALED,
    drop_incomplete,
    fitting_stages,
    parse_columns,
    preparation_stages,
)
from rarebird.operators.sampling import replicate_weights
from rarebird.operators.wide import BlockPCA, standardizer
from rarebird.sources.ledger import DONE, FAILED, RunLedger, append_once
from rarebird.sources.models import join_stages, load_pipeline, save_model
from rarebird.session import remove_at_exit, remove_path, scratch_path
from rarebird.sources.tables import append_table, overwrite_table, refresh, sql_source, table_location

log = logging.getLogger(__name__)


@dataclass
class RunReport:
    """What a job produced. ``metrics`` are the monitoring rows it appended (or would append)."""

    metrics: DataFrame | None = None
    result: DataFrame | None = None
    model: PipelineModel | None = None
    k: int | None = None
    silhouette: float | None = None
    scores: dict = field(default_factory=dict)
    skipped: dict = field(default_factory=dict)  # candidate k that did not suit the data, and why
    error: BaseException | None = None


#: what tells the monitoring rows of a run apart
MONITORING_KEYS = ["id_momento", "proyecto", "modelo", "ejecucion", "id_indicador", "nombre_indicador"]


def _append(rows: DataFrame, metric_table: str | None, table_root: str | None, once: bool) -> None:
    """Monitoring rows to their table, if there is one; ``once``: none that it already has."""
    if not metric_table:
        return
    where = table_location(table_root, metric_table)
    if once:
        append_once(rows, metric_table, MONITORING_KEYS, path=where)
    else:
        append_table(rows, metric_table, path=where)


def _fail(spark, family, stage, moment, project, metric_table, on_error, err, table_root=None, once=False) -> RunReport:
    row = M.failure_row(spark, family, stage, moment, project)
    _append(row, metric_table, table_root, once)
    if on_error == "raise":
        raise err
    log.error("%s %s failed: %s", family, stage, err)
    return RunReport(metrics=row, error=err)


def fit_features(df: DataFrame, stages: list, id_col: str, max_width: int | None = None,
                 square: bool | None = None, wide: bool | None = None, output: str = FEATURES,
                 place: str | None = None) -> tuple[PipelineModel, DataFrame, str]:
    """Fit the preparation (its wide form where the driver cannot hold its width) and write the
    ``[id, features]`` frame; returns model, frame and folder.

    The pruned, filtered input is spread by the bytes of its rows and persisted while the stages are fitted (the
    width check, indexer, scaler and PCA each read it), then released once the compact feature frame
    is written as Parquet to the shared scratch folder (a large one as many bytes there as in memory, so that
    splits go by the rows): one scan of the source serves the whole fit phase, and a lost executor re-reads
    those files. The caller removes the folder. ``place`` adds a column
    that numbers the rows as they are written.
    """
    spark = df.sparkSession
    source = spread_rows(df, 8 * len(df.columns)).persist(StorageLevel.MEMORY_AND_DISK)
    where = scratch_path(spark, "replicates" if place else "features")
    try:
        prep = Pipeline(stages=fitting_stages(source, stages, max_width, square, wide)).fit(source)
        feats = prep.transform(source).select(id_col, output)
        if place:
            feats = feats.withColumn(place, F.monotonically_increasing_id())
        feats.write.options(**options_for(source.count() * 8 * len(df.columns))).parquet(where)
    except BaseException:
        remove_path(spark, where)
        raise
    finally:
        source.unpersist()
    return prep, spark.read.schema(feats.schema).parquet(where), where


def _kept(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Monitoring rows (one per class and model score) computed now, so that they outlive the run."""
    return spark.createDataFrame(rows.collect(), rows.schema)


def _shares_after_write(spark: SparkSession, rows: DataFrame, exit_table: str | None, class_col: str,
                        table_root: str | None = None) -> DataFrame:
    """Write the result once (if asked) and aggregate the shares from what was written."""
    if exit_table:
        overwrite_table(rows, exit_table, path=table_location(table_root, exit_table))
        refresh(spark, exit_table)
        return M.class_share(spark.table(exit_table).select(class_col), class_col)
    return M.class_share(rows.select(class_col), class_col)


# --------------------------------------------------------------------------- anomalies


def train_anomaly_model(
    spark: SparkSession,
    source: str | DataFrame,
    categorical: Sequence[str] | str | None,
    id_col: str,
    metric_table: str | None = None,
    pipeline_path: str | None = None,
    threshold: float = DEFAULT_THRESHOLD,
    exit_table: str | None = None,
    seed: int = 123,
    max_k: int = 6,
    ks: Iterable[int] | None = None,
    pca_k: int = 6,
    moment: str | None = None,
    project: str = M.PROJECT,
    on_error: str = "raise",
    table_root: str | None = None,
    parallelism: int | None = None,
    max_width: int | None = None,
    wide: bool | None = None,
    once: bool = False,
    **fit_params,
) -> RunReport:
    """Prepare (index, one-hot, assemble, centred scaling, PCA), search k for a Gaussian
    mixture by silhouette, save prep + mixture as one pipeline, flag rows no component claims
    with at least ``threshold``, store the flags and append the monitoring rows. ``max_width``
    limits the feature width and ``wide`` asks for the form of the preparation that needs no label or
    square on the driver (see :func:`rarebird.operators.features.fitting_stages`)."""
    moment = moment or run_moment()
    folder = None
    try:
        df = drop_incomplete(sql_source(spark, source))
        stages = preparation_stages(df.columns, categorical, id_col, scale=SCALE_CENTRED, pca_k=pca_k)
        prep, feats, folder = fit_features(df, stages, id_col, max_width, wide=wide)
        fit = cluster(feats, MIXTURE, stored=True, k=0, max_k=max_k, seed=seed, ks=ks, parallelism=parallelism, **fit_params)
        pipeline = join_stages(prep, fit.model)
        if pipeline_path:
            save_model(pipeline, pipeline_path)
        flags = flag_anomalies(fit.scored, id_col, threshold)
        shares = _shares_after_write(spark, stored_result(flags, id_col), exit_table, FLAG, table_root)
        metrics = _kept(spark, M.monitoring_union([
            M.anomaly_metric_rows(shares, moment, "train", project),
            M.model_metric_rows(spark, fit.silhouette, fit.k, moment, project),
        ]))
        _append(metrics, metric_table, table_root, once)
        # what is returned reads a stored table, or scores the source: never the deleted scratch folder
        result = spark.table(exit_table) if exit_table else flag_anomalies(pipeline.transform(spread(df)), id_col, threshold)
        return RunReport(metrics, result, pipeline, fit.k, fit.silhouette, fit.search.scores, fit.search.errors)
    except Exception as err:
        return _fail(spark, "anomaly", "train", moment, project, metric_table, on_error, err, table_root, once)
    finally:
        if folder is not None:
            remove_path(spark, folder)


def predict_anomalies(
    spark: SparkSession,
    source: str | DataFrame,
    id_col: str,
    pipeline_path: str | None = None,
    threshold: float = DEFAULT_THRESHOLD,
    exit_table: str | None = None,
    metric_table: str | None = None,
    moment: str | None = None,
    project: str = M.PROJECT,
    on_error: str = "raise",
    table_root: str | None = None,
    pipeline: PipelineModel | None = None,
    once: bool = False,
) -> RunReport:
    """Score with the saved pipeline (one narrow, shuffle-free stage), flag, store once,
    and append the share rows."""
    moment = moment or run_moment()
    try:
        df = spread(drop_incomplete(sql_source(spark, source)))
        model = pipeline if pipeline is not None else load_pipeline(pipeline_path)
        flags = flag_anomalies(model.transform(df), id_col, threshold)
        shares = _shares_after_write(spark, stored_result(flags, id_col), exit_table, FLAG, table_root)
        metrics = _kept(spark, M.anomaly_metric_rows(shares, moment, "predict", project))
        _append(metrics, metric_table, table_root, once)
        result = spark.table(exit_table) if exit_table else flags
        return RunReport(metrics, result, model)
    except Exception as err:
        return _fail(spark, "anomaly", "predict", moment, project, metric_table, on_error, err, table_root, once)


# --------------------------------------------------------------------------- segments


def train_segments(
    spark: SparkSession,
    source: str | DataFrame,
    categorical: Sequence[str] | str | None,
    id_col: str,
    metric_table: str | None = None,
    pipeline_path: str | None = None,
    seed: int = 123,
    max_k: int = 4,
    ks: Iterable[int] | None = None,
    moment: str | None = None,
    project: str = M.PROJECT,
    on_error: str = "raise",
    table_root: str | None = None,
    parallelism: int | None = None,
    max_width: int | None = None,
    wide: bool | None = None,
    once: bool = False,
    **fit_params,
) -> RunReport:
    """Prepare (centred scaling, no PCA), search k for k-means, save prep + k-means as one
    pipeline and append one share row per segment (named by ascending share)."""
    moment = moment or run_moment()
    folder = None
    try:
        df = drop_incomplete(sql_source(spark, source))
        stages = preparation_stages(df.columns, categorical, id_col, scale=SCALE_CENTRED)
        prep, feats, folder = fit_features(df, stages, id_col, max_width, wide=wide)
        fit = cluster(feats, KMEANS, stored=True, k=0, max_k=max_k, seed=seed, ks=ks, parallelism=parallelism, **fit_params)
        pipeline = join_stages(prep, fit.model)
        if pipeline_path:
            save_model(pipeline, pipeline_path)
        scored = fit.scored.select(id_col, F.col("prediction").cast("int").alias("prediction"))
        shares = M.class_share(scored.select("prediction"), "prediction")
        metrics = _kept(spark, M.segment_metric_rows(shares, moment, "train", project))
        _append(metrics, metric_table, table_root, once)
        result = segment_rows(pipeline.transform(spread(df)), id_col).withColumn(id_col, F.col(id_col).cast(df.schema[id_col].dataType))
        return RunReport(metrics, result, pipeline, fit.k, fit.silhouette, fit.search.scores, fit.search.errors)
    except Exception as err:
        return _fail(spark, "segment", "train", moment, project, metric_table, on_error, err, table_root, once)
    finally:
        if folder is not None:
            remove_path(spark, folder)


def segment_rows(scored: DataFrame, id_col: str) -> DataFrame:
    """P2 + P3 for segments: ``id string, prediction int``."""
    return scored.select(
        F.col(id_col).cast("string").alias(id_col), F.col("prediction").cast("int").alias("prediction")
    )


def predict_segments(
    spark: SparkSession,
    source: str | DataFrame,
    id_col: str,
    exit_table: str | None = None,
    pipeline_path: str | None = None,
    metric_table: str | None = None,
    moment: str | None = None,
    project: str = M.PROJECT,
    on_error: str = "raise",
    table_root: str | None = None,
    pipeline: PipelineModel | None = None,
    once: bool = False,
) -> RunReport:
    """E5: score with the saved pipeline, store ``id, prediction`` once, append share rows."""
    moment = moment or run_moment()
    try:
        df = spread(drop_incomplete(sql_source(spark, source)))
        model = pipeline if pipeline is not None else load_pipeline(pipeline_path)
        rows = segment_rows(model.transform(df), id_col)
        shares = _shares_after_write(spark, rows, exit_table, "prediction", table_root)
        metrics = _kept(spark, M.segment_metric_rows(shares, moment, "predict", project))
        _append(metrics, metric_table, table_root, once)
        return RunReport(metrics, spark.table(exit_table) if exit_table else rows, model)
    except Exception as err:
        return _fail(spark, "segment", "predict", moment, project, metric_table, on_error, err, table_root, once)


# --------------------------------------------------------------------------- bootstrap replicates

WEIGHT, PLACE = "draws", "row_place"


@dataclass
class ReplicateFrame:
    """The encoded (not yet scaled) rows of a source, written once for any number of replicates."""

    frame: DataFrame  # id, RAW vector, PLACE
    prep: PipelineModel
    width: int
    id_col: str


def replicate_frame(spark: SparkSession, source: str | DataFrame, categorical, id_col: str, max_width: int | None = None,
                    wide: bool | None = None) -> ReplicateFrame:
    """Encodes and assembles the complete rows of ``source`` once, numbers them and writes them to the
    shared scratch folder, where they stay until the driver ends. The number is a row's place in what was
    written: every replicate draws by it, and equal rows are drawn apart."""
    df = drop_incomplete(sql_source(spark, source))
    stages = preparation_stages(df.columns, categorical, id_col, scale=None, output=RAW)
    prep, frame, where = fit_features(df, stages, id_col, max_width, wide=wide, output=RAW, place=PLACE)
    remove_at_exit(spark, where)
    first = frame.select(RAW).first()
    if first is None:
        raise ValueError("no complete rows")
    return ReplicateFrame(frame, prep, first[0].size, id_col)


@contextmanager
def _replicate(base: ReplicateFrame, family: str, number: int, fraction: float, seed: int, key: str | None, centre: bool,
               pca_k: int | None, k: int, max_k: int, model_seed: int, parallelism: int | None, fit_params: dict):
    """(clustering, scored rows that outlast the block, scoring stages) of one weighted replicate. Scaling,
    components, fit, silhouettes and shares all read the same draw counts: the draw is made once and persisted,
    then its features are, which the clustering's rows read and which are released with the block. A lost
    executor's rows are drawn again from the written frame, and alike."""
    drawing = replicate_weights(base.frame, key or PLACE, number, fraction, seed, WEIGHT).select(base.id_col, RAW, WEIGHT)
    drawn = drawing.persist(StorageLevel.MEMORY_AND_DISK)
    feats = None
    try:
        sparse = not isinstance(base.frame.select(RAW).first()[0], DenseVector) and base.width > SHARED_WIDTH
        stages = [standardizer(drawn, base.width, RAW, SCALED if pca_k else FEATURES, WEIGHT, centre and not sparse)]
        if pca_k:
            stages.append(BlockPCA(pca_k, SCALED, FEATURES, weight=WEIGHT).fit(stages[0].transform(drawn)))
        featured = PipelineModel(stages).transform(drawing).select(base.id_col, FEATURES, WEIGHT)
        feats = featured.persist(StorageLevel.MEMORY_AND_DISK)
        feats.count()
        drawn.unpersist()
        fit = cluster(feats, family, stored=True, k=k, max_k=max_k, seed=model_seed, parallelism=parallelism, weight=WEIGHT, **fit_params)
        yield fit, fit.model.transform(featured), join_stages(base.prep, *stages, fit.model)
    finally:
        drawn.unpersist()
        if feats is not None:
            feats.unpersist()


def _repeated(rows: DataFrame) -> DataFrame:
    """One row per draw, as a resample with replacement holds them."""
    return rows.withColumn(WEIGHT, F.explode(F.sequence(F.lit(1), F.col(WEIGHT).cast("int")))).drop(WEIGHT)


def bootstrap_anomaly_replicates(
    spark: SparkSession,
    source: str | DataFrame | ReplicateFrame,
    categorical: Sequence[str] | str | None,
    id_col: str,
    replicates: Iterable[int],
    metric_table: str | None = None,
    threshold: float = DEFAULT_THRESHOLD,
    k: int = 0,
    max_k: int = 6,
    fraction: float = 0.5,
    pca_k: int = 4,
    seed: int = 0,
    key: str | None = None,
    model_seed: int = 123,
    moment: str | None = None,
    project: str = M.PROJECT,
    parallelism: int | None = None,
    table_root: str | None = None,
    max_width: int | None = None,
    wide: bool | None = None,
    **fit_params,
) -> Iterator[RunReport]:
    """E3, many times: a report per replicate number, from one feature frame and a weight per row and number.

    A row's weight is its number of draws, a hash of its place and the replicate (of ``key`` instead, if
    given; rows of equal key are then drawn alike), so no row is copied or drawn again, and the rows that
    were fitted are the rows reported. Each replicate refits scaling, PCA and mixture (k given, or searched).
    """
    moment = moment or run_moment()
    base = source if isinstance(source, ReplicateFrame) else replicate_frame(spark, source, categorical, id_col, max_width, wide)
    for number in replicates:
        with _replicate(base, MIXTURE, number, fraction, seed, key, True, pca_k, k, max_k, model_seed, parallelism,
                        fit_params) as (fit, scored, model):
            flags = flag_anomalies(fit.scored, id_col, threshold, keep=[WEIGHT])
            metrics = _kept(spark, M.monitoring_union([
                M.anomaly_metric_rows(M.class_share(flags, FLAG, WEIGHT), moment, "train", project),
                M.model_metric_rows(spark, fit.silhouette, fit.k, moment, project),
            ]))
        _append(metrics, metric_table, table_root, False)
        result = _repeated(flag_anomalies(scored, id_col, threshold, keep=[WEIGHT]))
        yield RunReport(metrics, result, model, fit.k, fit.silhouette)


def bootstrap_segment_replicates(
    spark: SparkSession,
    source: str | DataFrame | ReplicateFrame,
    categorical: Sequence[str] | str | None,
    id_col: str,
    replicates: Iterable[int],
    metric_table: str | None = None,
    k: int = 0,
    max_k: int = 6,
    fraction: float = 1.0,
    seed: int = 0,
    key: str | None = None,
    model_seed: int = 123,
    moment: str | None = None,
    project: str = M.PROJECT,
    parallelism: int | None = None,
    table_root: str | None = None,
    max_width: int | None = None,
    wide: bool | None = None,
    **fit_params,
) -> Iterator[RunReport]:
    """E6, many times (scale-only standardization, k-means); draws as in
    :func:`bootstrap_anomaly_replicates`."""
    moment = moment or run_moment()
    base = source if isinstance(source, ReplicateFrame) else replicate_frame(spark, source, categorical, id_col, max_width, wide)
    for number in replicates:
        rows = [id_col, F.col("prediction").cast("int").alias("prediction"), WEIGHT]
        with _replicate(base, KMEANS, number, fraction, seed, key, False, None, k, max_k, model_seed, parallelism,
                        fit_params) as (fit, scored, model):
            shares = M.class_share(fit.scored.select(*rows), "prediction", WEIGHT)
            metrics = _kept(spark, M.segment_metric_rows(shares, moment, "train", project))
        _append(metrics, metric_table, table_root, False)
        yield RunReport(metrics, _repeated(scored.select(*rows)), model, fit.k, fit.silhouette)


def bootstrap_anomalies(spark: SparkSession, source, categorical, id_col: str, metric_table: str | None = None,
                        seed: int | None = None, **params) -> RunReport:
    """One replicate of :func:`bootstrap_anomaly_replicates`, under a new seed unless one is given.
    Repeated calls build the distribution of shares in the monitoring table."""
    return next(bootstrap_anomaly_replicates(spark, source, categorical, id_col, [0], metric_table, seed=_seed(seed), **params))


def bootstrap_segments(spark: SparkSession, source, categorical, id_col: str, metric_table: str | None = None,
                       seed: int | None = None, **params) -> RunReport:
    """One replicate of :func:`bootstrap_segment_replicates`, under a new seed unless one is given."""
    return next(bootstrap_segment_replicates(spark, source, categorical, id_col, [0], metric_table, seed=_seed(seed), **params))


def _seed(seed: int | None) -> int:
    return random.randrange(1 << 31) if seed is None else seed


# --------------------------------------------------------------------------- composed jobs


@dataclass
class JobConfig:
    """Typed parameters of the composed jobs (one field per setting the jobs read)."""

    anomaly_query: str
    anomaly_id: str
    anomaly_categorical: list[str]
    segment_query: str
    segment_id: str
    segment_categorical: list[str]
    enrich_query: str
    anomaly_pipeline: str
    segment_pipeline: str
    anomaly_exit_table: str
    enriched_table: str
    segment_exit_table: str | None = None
    anomaly_metric_table: str | None = None
    segment_metric_table: str | None = None
    threshold: float = DEFAULT_THRESHOLD
    dedupe_order: list[str] | None = None
    table_root: str | None = None
    ledger_table: str | None = None

    @classmethod
    def from_mapping(cls, params: dict, stage: str = "train", table_root: str | None = None) -> "JobConfig":
        """Build from the nested settings layout the original jobs read (``stage`` picks the
        train or predict entries)."""
        # The setting names of that layout.
        out, ids, cats = params["tablas_salida"], params["columnas_identificacion"], params["columnas_categoricas"]
        queries, models, monitor = params["consultas"], params["modelos"], params["tablas_monitoreo"]
        train = stage == "train"
        return cls(
            anomaly_query=queries["anomalias_entrenamiento" if train else "anomalias_prediccion"],
            anomaly_id=ids["anomalias"],
            anomaly_categorical=parse_columns(cats.get("anomalias", "")),
            segment_query=queries["segmentacion_entrenamiento" if train else "segmentacion_prediccion"],
            segment_id=ids["segmentacion"],
            segment_categorical=parse_columns(cats.get("segmentacion", "")),
            enrich_query=queries["cruce_resultado_entrenamiento" if train else "cruce_resultado_prediccion"],
            anomaly_pipeline=models["anomalias"],
            segment_pipeline=models["segmentacion"],
            anomaly_exit_table=out["exitTable_anomalies_train" if train else "exitTable_anomalies_predict"],
            enriched_table=out[
                "exitTable_resultado_enriquecido_train" if train else "exitTable_resultado_enriquecido_predict"
            ],
            segment_exit_table=out.get("exitTableSegmentation"),
            anomaly_metric_table=monitor.get("monitoring_anomalies"),
            segment_metric_table=monitor.get("monitoring_segmentation"),
            threshold=float(params.get("threshold", DEFAULT_THRESHOLD)),
            dedupe_order=parse_columns(params.get("dedupe_order")) or None,  # "-column" for descending
            table_root=table_root,
            ledger_table=params.get("ledger_table"),
        )


@dataclass
class JobReport:
    anomalies: RunReport
    enriched: DataFrame | None
    segments: RunReport


def _enrich_step(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    enriched = enrich_and_dedupe(spark, cfg.enrich_query, cfg.segment_id, cfg.dedupe_order)
    overwrite_table(enriched, cfg.enriched_table, path=table_location(cfg.table_root, cfg.enriched_table))
    refresh(spark, cfg.enriched_table)
    return spark.table(cfg.enriched_table)


class StepSkipped(RuntimeError):
    """A step that was not run, as the one whose table it reads failed."""


class _Run:
    """One call of a composed job: its ledger (if it has an id) and what became of its steps."""

    def __init__(self, spark: SparkSession, cfg: JobConfig, run_id: str | None, moment: str):
        if run_id and not cfg.ledger_table:
            raise ValueError("a run id needs the configuration's ledger_table")
        self.spark, self.cfg, self.run_id = spark, cfg, run_id
        self.ledger = RunLedger(spark, cfg.ledger_table, table_location(cfg.table_root, cfg.ledger_table)) if run_id else None
        self.moment = self.ledger.begin(run_id, moment) if run_id else moment

    def step(self, name: str, run, resumed):
        """``run()``, or ``resumed()`` if this run has done the step before."""
        if self.ledger and self.ledger.is_done(self.run_id, name):
            return resumed()
        got = run()
        if self.ledger:
            error = got.error if isinstance(got, RunReport) else None
            detail = None if error is None else f"{type(error).__name__}: {error}"[:1000]
            self.ledger.record(self.run_id, name, FAILED if error else DONE, self.moment, detail)
        return got

    def stored(self, table: str | None, pipeline: str | None = None) -> RunReport:
        """The report of a step that an earlier call finished: what it stored."""
        return RunReport(result=self.spark.table(table) if table else None, model=load_pipeline(pipeline) if pipeline else None)


def _compose(run: _Run, stage: str, on_error: str, after_failure: str, anomalies, segments) -> JobReport:
    """Anomaly step, enrichment, segment step. After a recorded failure of the first, the enrichment would
    read whatever table an older run left, so it is not run and the segment step leaves its failure row;
    ``after_failure="continue"`` goes on all the same."""
    if after_failure not in ("stop", "continue"):
        raise ValueError("after_failure must be 'stop' or 'continue'")
    spark, cfg = run.spark, run.cfg
    first = run.step("anomalies", anomalies, lambda: run.stored(cfg.anomaly_exit_table, cfg.anomaly_pipeline))
    if first.error is not None and after_failure == "stop":
        err = StepSkipped(f"the anomaly step failed: {first.error}")
        skipped = _fail(spark, "segment", stage, run.moment, M.PROJECT, cfg.segment_metric_table, on_error, err, cfg.table_root, run.run_id is not None)
        return JobReport(first, None, skipped)
    enriched = run.step("enriched", lambda: _enrich_step(spark, cfg), lambda: spark.table(cfg.enriched_table))
    last = run.step("segments", segments, lambda: run.stored(cfg.segment_exit_table if stage == "predict" else None, cfg.segment_pipeline))
    return JobReport(first, enriched, last)


def training_job(spark: SparkSession, cfg: JobConfig, moment: str | None = None, on_error: str = "record",
                 anomaly_params: dict | None = None, segment_params: dict | None = None, run_id: str | None = None,
                 after_failure: str = "stop") -> JobReport:
    """Anomaly training -> enrichment + dedup -> segment training, each model with settings of its
    own (``anomaly_params`` and ``segment_params`` go to the two train jobs). With the default
    ``on_error="record"`` a failing step leaves its failure row (see ``_compose`` for what follows it).

    With a ``run_id`` the steps are recorded in the configuration's ``ledger_table``: a call under the same
    id resumes at the step that did not finish and appends no monitoring row twice.
    """
    run = _Run(spark, cfg, run_id, moment or run_moment())
    shared = {"moment": run.moment, "on_error": on_error, "table_root": cfg.table_root, "once": run_id is not None}
    return _compose(run, "train", on_error, after_failure, lambda: train_anomaly_model(
        spark, cfg.anomaly_query, cfg.anomaly_categorical, cfg.anomaly_id, cfg.anomaly_metric_table,
        cfg.anomaly_pipeline, cfg.threshold, cfg.anomaly_exit_table, **shared, **(anomaly_params or {}),
    ), lambda: train_segments(
        spark, cfg.segment_query, cfg.segment_categorical, cfg.segment_id, cfg.segment_metric_table,
        cfg.segment_pipeline, **shared, **(segment_params or {}),
    ))


def prediction_job(spark: SparkSession, cfg: JobConfig, moment: str | None = None,
                   on_error: str = "record", run_id: str | None = None, after_failure: str = "stop") -> JobReport:
    """Anomaly scoring -> enrichment + dedup -> segment scoring; ``run_id`` and ``after_failure`` as in
    :func:`training_job`."""
    run = _Run(spark, cfg, run_id, moment or run_moment())
    shared = {"moment": run.moment, "on_error": on_error, "table_root": cfg.table_root, "once": run_id is not None}
    return _compose(run, "predict", on_error, after_failure, lambda: predict_anomalies(
        spark, cfg.anomaly_query, cfg.anomaly_id, cfg.anomaly_pipeline, cfg.threshold, cfg.anomaly_exit_table,
        cfg.anomaly_metric_table, **shared,
    ), lambda: predict_segments(
        spark, cfg.segment_query, cfg.segment_id, cfg.segment_exit_table, cfg.segment_pipeline,
        cfg.segment_metric_table, **shared,
    ))
