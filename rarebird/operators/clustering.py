"""Clustering and scoring.

Gaussian mixture and k-means are Spark ML's distributed estimators: every EM / Lloyd
iteration is one pass over the training vectors that combines per partition and then reduces
k small per-cluster summaries, and the model (k means and k d x d covariances) is the only
thing that lives on the driver. Scoring is a narrow
projection. The silhouette is Spark's squared-Euclidean ``ClusteringEvaluator``: one
aggregate of per-cluster sums, then one pass, O(n * k).

Fits of dense vectors run the EM or Lloyd rounds of all candidates k in shared passes over one packed copy
of the vectors and score all of them in two (:mod:`rarebird.operators.shared_search`); the starts of k-means
candidates are Spark's, several at once (the same driver-thread parallelism ``CrossValidator`` uses). The
fitted winner is handed back, so it is never refitted.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import IllegalArgumentException
from pyspark.ml.clustering import GaussianMixture, GaussianMixtureModel, KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarebird.operators.layout import spread_rows
from rarebird.operators.shared_search import (
    fit_kmeans,
    fit_mixtures,
    kmeans_model,
    mixture_model,
    mixture_silhouettes,
    packed,
    start_centres,
    starts,
)
from rarebird.operators.shared_search import kmeans_silhouettes as silhouettes

log = logging.getLogger(__name__)

MIXTURE = "mixture"
KMEANS = "kmeans"
DEFAULT_SEED = 123
FIRST_K = 3
# Candidates started (or, without shared passes, fitted) at once by default. Steps of a small input are
# bound by the driver, which overlapping candidates hide. Without shared passes each running candidate
# holds its own copy of the training vectors: there set parallelism=1 on a large input.
DEFAULT_PARALLELISM = 4
#: widest vectors that shared passes take; wider (or sparse) ones are fitted and scored one k at a time
SHARED_WIDTH = 1024


def mixture(k: int, seed: int = DEFAULT_SEED, features: str = "features", max_iter: int = 100,
            tol: float = 0.01, weight: str | None = None) -> GaussianMixture:
    """M1: Gaussian mixture with full covariances (needs k > 1); ``weight`` names a column of row weights."""
    return GaussianMixture(k=k, seed=seed, featuresCol=features, maxIter=max_iter, tol=tol, **_weighted(weight))


def kmeans(k: int, seed: int = DEFAULT_SEED, features: str = "features", max_iter: int = 20,
           tol: float = 1e-4, weight: str | None = None) -> KMeans:
    """M2: k-means (k-means|| initialisation); ``weight`` as for a mixture."""
    return KMeans(k=k, seed=seed, featuresCol=features, maxIter=max_iter, tol=tol, **_weighted(weight))


def _weighted(weight: str | None) -> dict:
    return {"weightCol": weight} if weight else {}


ESTIMATORS: dict[str, Callable[..., object]] = {MIXTURE: mixture, KMEANS: kmeans}


def estimator(family: str, k: int, **params):
    try:
        make = ESTIMATORS[family]
    except KeyError:
        raise ValueError(f"family must be one of {sorted(ESTIMATORS)}") from None
    return make(k, **params)


def silhouette(scored: DataFrame, features: str = "features", prediction: str = "prediction", weight: str | None = None) -> float:
    """M7: mean squared-Euclidean silhouette; raises when fewer than two clusters are used."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=prediction, **_weighted(weight)).evaluate(scored)


def model_k(model) -> int:
    """Number of clusters of a fitted mixture or k-means model."""
    if isinstance(model, (GaussianMixtureModel, KMeansModel)):
        return int(model.getK())
    return int(model.getOrDefault("k"))


@contextmanager
def fit_frame(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK, stored: bool = False, features: str = "features"):
    """The frame iterative fits should read.

    A ``stored`` frame (one that reads a written feature table) is handed over as it is; any other frame
    is spread by the bytes of its vectors and persisted once for the block. The persisted frame itself is
    handed over, not a projection of it: of an input that is not cached Spark's own estimators keep a
    *deserialized* copy of the training vectors, several times their bytes.

    MEMORY_AND_DISK spills instead of recomputing; a lost executor's blocks are read again from the
    written features, or rebuilt from scan, filter and fitted transforms.
    """
    if stored:
        yield df
        return
    own = not df.is_cached
    first = df.select(features).first() if own else None
    work = (spread_rows(df, 8 * len(first[0].values)) if first else df).persist(level) if own else df
    try:
        yield work
    finally:
        if own:
            work.unpersist()


@dataclass
class KSearch:
    """Outcome of a k search: the chosen k, its silhouette and fitted model, all scores."""

    k: int
    silhouette: float | None
    model: object | None
    scores: dict[int, float | None] = field(default_factory=dict)
    errors: dict[int, str] = field(default_factory=dict)


def _one_cluster(err: Py4JJavaError) -> bool:
    """Whether the evaluator refused a clustering that uses a single cluster."""
    cause = err.java_exception
    return cause.getClass().getSimpleName() == "AssertionError" and "clusters must be greater than one" in str(cause.getMessage())


def _score(df: DataFrame, features: str, weight: str | None = None) -> tuple[float | None, str | None]:
    """(silhouette, reason there is none)."""
    try:
        score = silhouette(df, features=features, **({"weight": weight} if weight else {}))
    except IllegalArgumentException as err:
        return None, f"{type(err).__name__}: {err}"
    except Py4JJavaError as err:
        if not _one_cluster(err):
            raise
        return None, "one cluster only"
    return (None, "silhouette is NaN") if score is None or math.isnan(score) else (float(score), None)


def _try_k(df: DataFrame, family: str, k: int, features: str, params: dict):
    """(k, silhouette, model, reason it was skipped). Only what says that this k does not suit the
    data skips it: an argument the estimator or the evaluator refuses (such as a model that uses a
    single cluster), or a NaN score. Anything else, a lost stage above all, is raised."""
    est = estimator(family, k, features=features, **params)
    try:
        model = est.fit(df)
    except IllegalArgumentException as err:
        return k, None, None, f"{type(err).__name__}: {err}"
    score, reason = _score(model.transform(df), features, params.get("weight"))
    return k, score, model if score is not None else None, reason


def _judged(k: int, score: float | None, model):
    if score is None:
        return k, None, model, "one cluster only"
    return (k, None, model, "silhouette is NaN") if math.isnan(score) else (k, score, model, None)


def _shared_mixtures(df: DataFrame, ks: list[int], features: str, seed: int, max_iter: int = 100, tol: float = 0.01,
                     weight: str | None = None, scored: bool = True) -> list:
    """The results of ``_try_k`` for mixtures of every k, from shared passes."""
    out = [(k, None, None, f"IllegalArgumentException: a mixture needs more than one component, not {k}") for k in ks if k < 2]
    mixtures = starts(df, features, [k for k in ks if k > 1], seed, weight)
    with packed(df, features, weight) as blocks:
        failed = fit_mixtures(blocks, mixtures, max_iter, tol)
        out += [(k, None, None, reason) for k, reason in failed.items()]
        live = [m for m in mixtures if m.k not in failed]
        scores = mixture_silhouettes(blocks, live) if live and scored else []
    models = [mixture_model(df.sparkSession, m, features, seed, max_iter, tol) for m in live]
    return sorted(out + _judged_all([m.k for m in live], scores, models, scored), key=lambda r: r[0])


def _shared_kmeans(df: DataFrame, ks: list[int], features: str, seed: int, max_iter: int = 20, tol: float = 1e-4,
                   weight: str | None = None, workers: int = 1, scored: bool = True) -> list:
    """The results of ``_try_k`` for k-means of every k, from shared passes after Spark's starts."""

    def begin(k: int):
        try:
            return start_centres(df, features, k, seed, weight)
        except IllegalArgumentException as err:
            return f"{type(err).__name__}: {err}"

    begun = dict(zip(ks, _each(df, begin, ks, workers)))
    out = [(k, None, None, reason) for k, reason in begun.items() if isinstance(reason, str)]
    live, scores, centres = [k for k, c in begun.items() if not isinstance(c, str)], [], []
    if live:
        with packed(df, features, weight) as blocks:
            centres = fit_kmeans(blocks, [begun[k] for k in live], max_iter, tol)
            scores = silhouettes(blocks, centres) if scored else []
    models = [kmeans_model(df.sparkSession, c, k, features, seed, max_iter, tol, weight) for k, c in zip(live, centres)]
    return sorted(out + _judged_all(live, scores, models, scored), key=lambda r: r[0])


def _judged_all(ks: list[int], scores: list, models: list, scored: bool) -> list:
    if not scored:
        return [(k, None, model, None) for k, model in zip(ks, models)]
    return [_judged(k, s, model) for k, s, model in zip(ks, scores, models)]


def _each(df: DataFrame, run: Callable, ks: list[int], workers: int) -> list:
    """``run(k)`` of every k, ``workers`` at a time."""
    workers = max(1, min(workers, len(ks)))
    if workers == 1:
        return [run(k) for k in ks]
    # inheritable threads: job group, scheduler pool and cancellation reach every candidate
    with ThreadPoolExecutor(max_workers=workers) as pool:
        return list(pool.map(inheritable_thread_target(df.sparkSession)(run), ks))


def _fit_given(df: DataFrame, family: str, k: int, features: str, seed: int, with_silhouette: bool, params: dict, shared: bool | None):
    """(model, silhouette, reason there is none) of a fit of one given k."""
    if k > 1 and family in ESTIMATORS and (_dense(df, features) if shared is None else shared):
        fit = _shared_mixtures if family == MIXTURE else _shared_kmeans
        [(_, score, model, reason)] = fit(df, [k], features, seed, **params, scored=with_silhouette)
        if model is not None:
            return model, score, reason
    model = estimator(family, k, seed=seed, features=features, **params).fit(df)
    return (model, *(_score(model.transform(df), features, params.get("weight")) if with_silhouette else (None, None)))


def _dense(df: DataFrame, features: str) -> bool:
    """Whether the vectors are such as shared passes take."""
    first = df.select(features).first()
    return first is not None and isinstance(first[0], DenseVector) and first[0].size <= SHARED_WIDTH


def choose_k(
    df: DataFrame,
    family: str = MIXTURE,
    ks: Iterable[int] | None = None,
    max_k: int = 6,
    seed: int = DEFAULT_SEED,
    features: str = "features",
    parallelism: int | None = None,
    shared: bool | None = None,
    **params,
) -> KSearch:
    """M5 / M6: fit every candidate k (default 3..max_k), score each by silhouette and keep
    the best; equal scores go to the smaller k. A k that does not suit the data (one cluster only,
    a refused argument, a NaN score) is skipped and its reason kept in ``errors``; when all are
    skipped the answer is k = 3 with no silhouette and no model. Any other failure is raised.

    An empty input is an error, not a skipped candidate. ``shared=False`` fits and scores one k at a time
    (as sparse vectors and those wider than ``SHARED_WIDTH`` are by default).
    """
    with fit_frame(df, features=features) as work:
        return _search(work, family, ks, max_k, seed, features, parallelism, params, shared)


def _search(work, family, ks, max_k, seed, features, parallelism, params, shared=None) -> KSearch:
    candidates = sorted(set(ks if ks is not None else range(FIRST_K, max_k + 1)))
    if work.select(features).first() is None:
        raise ValueError("k search on an empty frame")
    if shared is None:
        shared = _dense(work, features)
    if family not in ESTIMATORS:
        raise ValueError(f"family must be one of {sorted(ESTIMATORS)}")
    workers = parallelism or DEFAULT_PARALLELISM
    if shared and family == MIXTURE:
        return _outcome(_shared_mixtures(work, candidates, features, seed, **params))
    if shared:
        return _outcome(_shared_kmeans(work, candidates, features, seed, **params, workers=workers))
    params = dict(params, seed=seed)
    return _outcome(_each(work, lambda k: _try_k(work, family, k, features, params), candidates, workers))


def _outcome(results: list) -> KSearch:
    """The best of (k, silhouette, model, reason it was skipped) rows."""
    scores = {k: s for k, s, _, _ in results}
    errors = {k: e for k, _, _, e in results if e}
    for k, e in errors.items():
        log.warning("k=%d skipped: %s", k, e)
    fitted = [(s, k, m) for k, s, m, _ in results if s is not None]
    if not fitted:
        return KSearch(FIRST_K, None, None, scores, errors)
    best = max(fitted, key=lambda t: (t[0], -t[1]))
    return KSearch(best[1], best[0], best[2], scores, errors)


@dataclass
class Clustering:
    """Scored rows (``prediction``, plus ``probability`` for mixtures) and the model behind them."""

    scored: DataFrame
    model: object
    k: int
    silhouette: float | None
    search: KSearch | None = None


def cluster(
    df: DataFrame,
    family: str = MIXTURE,
    k: int = 0,
    max_k: int = 6,
    seed: int = DEFAULT_SEED,
    trained_model=None,
    model_path: str | None = None,
    features: str = "features",
    with_silhouette: bool = True,
    parallelism: int | None = None,
    ks: Iterable[int] | None = None,
    stored: bool = False,
    shared: bool | None = None,
    **params,
) -> Clustering:
    """M8 / M9: score with a trained model, or fit with a given k, or search k (``k == 0``).

    The search's winner is used as is (no second fit). ``model_path`` saves the fitted model;
    ``stored`` says that ``df`` reads a written feature table (see :func:`fit_frame`).
    """
    search = None
    if trained_model is not None:
        model = trained_model
        scored = model.transform(df)
        score = silhouette(scored, features=features) if with_silhouette else None
        return Clustering(scored, model, model_k(model), score)
    with fit_frame(df, stored=stored, features=features) as work:
        if k == 0:
            search = _search(work, family, ks, max_k, seed, features, parallelism, params, shared)
            model, score, k = search.model, search.silhouette, search.k
            if model is None:
                model = estimator(family, k, seed=seed, features=features, **params).fit(work)
        else:
            model, score, reason = _fit_given(work, family, k, features, seed, with_silhouette, params, shared)
            if reason:
                log.warning("silhouette not available for k=%d: %s", k, reason)
    if model_path:
        model.write().overwrite().save(model_path)
    # scoring is a narrow projection of the caller's frame (no repartition, no shuffle)
    return Clustering(model.transform(df), model, k, score, search)


def segment_prediction(
    df: DataFrame, id_col: str, family: str = KMEANS, k: int = 0, max_k: int = 6, seed: int = DEFAULT_SEED,
    trained_model=None, features: str = "features", **params,
) -> DataFrame:
    """``id, prediction`` for a feature frame (one projection of the scored rows)."""
    result = cluster(df, family=family, k=k, max_k=max_k, seed=seed, trained_model=trained_model,
                     features=features, with_silhouette=False, **params)
    return result.scored.select(F.col(id_col), F.col("prediction").cast("int").alias("prediction"))


_QUERY_K_DEFAULTS = {
    # family: (scale, pca_k, max_k) - the anomaly helper searched 3..4 on PCA-4 centred features,
    # the segment helper 3..6 on scale-only features
    MIXTURE: ("centred", 4, 4),
    KMEANS: ("scale_only", None, 6),
}


def k_for_query(
    spark,
    source,
    categorical,
    id_col: str | None = None,
    family: str = MIXTURE,
    scale: str | None = None,
    pca_k: int | None = None,
    max_k: int | None = None,
    seed: int = DEFAULT_SEED,
    **params,
) -> int:
    """The cluster count a query's rows call for: read (SQL or DataFrame), drop
    incomplete rows, prepare and search k by silhouette. Unset preparation and range follow the
    family: mixture - centred, PCA 4, k 3..4; k-means - scale only, no PCA, k 3..6."""
    from rarebird.operators.features import drop_incomplete, prepare
    from rarebird.sources.tables import sql_source

    d_scale, d_pca, d_max = _QUERY_K_DEFAULTS[family]
    df = drop_incomplete(sql_source(spark, source))
    feats = prepare(df, categorical, id_col, scale=scale or d_scale, pca_k=pca_k if pca_k is not None else d_pca).frame
    return choose_k(feats, family, max_k=max_k or d_max, seed=seed, features="features", **params).k
