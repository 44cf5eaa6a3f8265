"""Shared passes of a k search against fits and scores of one k at a time."""

import numpy as np
import pytest
from pyspark.ml.clustering import GaussianMixture, GaussianMixtureModel, KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from rarebird.operators import shared_search as SS
from rarebird.operators.clustering import KMEANS, MIXTURE, choose_k, cluster, silhouette
from rarebird.operators.features import prepare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def feats(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    return prepare(li, ["l_returnflag"], "id", pca_k=4).frame.persist()


def separate_fits(feats, ks, **params):
    return {k: GaussianMixture(k=k, seed=123, **params).fit(feats) for k in ks}


@pytest.mark.parametrize("tol,max_iter", [(0.01, 100), (0.01, 7)])
def test_mixtures_end_where_their_own_fits_end(spark, feats, tol, max_iter):
    ks = [2, 3, 4, 5]
    own = separate_fits(feats, ks, tol=tol, maxIter=max_iter)
    mixtures = [SS.start(feats, "features", k, 123) for k in ks]
    with SS.packed(feats) as blocks:
        assert SS.fit_mixtures(blocks, mixtures, max_iter, tol) == {}
    for m in mixtures:
        summary = own[m.k].summary
        assert m.rounds == summary.numIter
        assert m.log_likelihood == pytest.approx(summary.logLikelihood, rel=1e-9)
        assert np.allclose(m.weights, own[m.k].weights, atol=1e-6)
        model = SS.mixture_model(spark, m, "features", 123, max_iter, tol)
        a = model.transform(feats).select("prediction", vector_to_array("probability").alias("p"))
        b = own[m.k].transform(feats).select("prediction", vector_to_array("probability").alias("p"))
        for x, y in zip(a.collect(), b.collect()):
            assert x.prediction == y.prediction and np.allclose(x.p, y.p, atol=1e-5)


def test_search_gives_the_k_of_separate_fits_in_fewer_passes(spark, feats):
    jobs = {}
    for shared in (True, False):
        spark.sparkContext.setJobGroup(f"search-{shared}", "")
        found = choose_k(feats, MIXTURE, ks=[3, 4, 5], seed=123, max_iter=25, shared=shared, parallelism=1)
        jobs[shared] = (found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"search-{shared}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    (a, n), (b, m) = jobs[True], jobs[False]
    assert a.k == b.k and a.scores.keys() == b.scores.keys()
    assert all(a.scores[k] == pytest.approx(b.scores[k], abs=1e-6) for k in a.scores)
    assert n < 0.7 * m


def test_saved_models_load(spark, feats, scratch_dir):
    found = cluster(feats, MIXTURE, ks=[3], max_iter=5, model_path=f"{scratch_dir}/m")
    loaded = GaussianMixtureModel.load(f"{scratch_dir}/m")
    rows = lambda m: [r.prediction for r in m.transform(feats).select("prediction").collect()]
    assert rows(loaded) == rows(found.model) and loaded.getK() == 3


def test_silhouettes_of_all_candidates_equal_the_evaluator(spark, feats):
    scored = feats
    for k in (2, 3, 5):
        scored = KMeans(k=k, seed=1, predictionCol=f"p{k}").fit(feats).transform(scored)
    scored = scored.withColumn("one", F.lit(0)).withColumn("lone", F.when(F.col("id") == feats.first().id, 4).otherwise(1))
    got = SS.silhouettes(scored, ["p2", "p3", "p5", "one", "lone"])
    for name, score in zip(["p2", "p3", "p5", "lone"], [got[0], got[1], got[2], got[4]]):
        assert score == pytest.approx(silhouette(scored.withColumn("prediction", F.col(name).cast("double"))), abs=1e-9)
    assert got[3] is None
    weighted = scored.withColumn("w", F.pmod("id", F.lit(3)).cast("double"))
    repeated = weighted.where("w > 0").select("*", F.explode(F.sequence(F.lit(1), F.col("w").cast("int"))).alias("copy"))
    assert SS.silhouettes(weighted, ["p3"], weight="w")[0] != got[1]
    from pyspark.ml.evaluation import ClusteringEvaluator
    evaluator = ClusteringEvaluator(predictionCol="prediction", weightCol="w")
    assert SS.silhouettes(weighted.where("w > 0"), ["p3"], weight="w")[0] == pytest.approx(
        evaluator.evaluate(weighted.where("w > 0").withColumn("prediction", F.col("p3").cast("double"))), abs=1e-9)
    assert repeated.count() > 0


def test_sparse_rows_many_tasks_and_bad_rows(spark, monkeypatch):
    monkeypatch.setattr(SS, "_DIRECT_TASKS", 2)
    rng = np.random.default_rng(0)
    rows = [(Vectors.dense([0, x, y]) if k % 2 else Vectors.sparse(3, [1, 2], [x, y]), k % 3) for k, (x, y) in enumerate(rng.standard_normal((90, 2)) + 5)]
    df = spark.createDataFrame(rows, ["features", "p"]).repartition(7)
    assert SS.silhouettes(df, ["p"])[0] == pytest.approx(silhouette(df.withColumn("prediction", F.col("p").cast("double"))), abs=1e-9)
    with pytest.raises(Exception, match="NaN"):
        SS.silhouettes(spark.createDataFrame([(Vectors.dense([float("nan")]), 0)], ["features", "p"]), ["p"])
    same = spark.createDataFrame([(Vectors.dense([1.0]),)] * 20, ["features"])
    found = choose_k(same, MIXTURE, ks=[1, 2])
    assert found.k == 3 and found.model is None and "no spread" in found.errors[2] and 1 in found.errors
    assert choose_k(same, KMEANS, ks=[2]).errors == {2: "one cluster only"}


@pytest.mark.parametrize("max_iter", [20, 3])
def test_kmeans_ends_where_its_own_fits_end(spark, feats, max_iter):
    """Findings 5, 7, 8 and 10 to 16: every candidate's rounds run in shared passes, over one packed copy."""
    weighted = feats.withColumn("w", (F.col("id") % 3 + 1).cast("double"))
    for frame, extra in ((feats, {}), (weighted, {"weight": "w"})):
        starts = [SS.start_centres(frame, "features", k, 123, **extra) for k in (3, 5)]
        with SS.packed(frame, "features", extra.get("weight")) as blocks:
            ended = SS.fit_kmeans(blocks, starts, max_iter)
            scores = SS.kmeans_silhouettes(blocks, ended)
        for k, centres, score in zip((3, 5), ended, scores):
            own = KMeans(k=k, seed=123, maxIter=max_iter, **({"weightCol": "w"} if extra else {})).fit(frame)
            assert np.allclose(centres, own.clusterCenters(), atol=1e-9)
            model = SS.kmeans_model(spark, centres, k, "features", 123, max_iter, 1e-4, extra.get("weight"))
            assert model.transform(frame).exceptAll(own.transform(frame)).isEmpty() and model.getK() == k
            assert score == pytest.approx(silhouette(own.transform(frame), **extra), abs=1e-9)


def test_a_kmeans_search_fits_nothing_one_by_one(spark, feats, monkeypatch):
    import rarebird.operators.clustering as C

    def refuse(*_, **__):
        raise AssertionError("fitted on its own")

    monkeypatch.setattr(C, "estimator", refuse)
    found = cluster(feats, KMEANS, ks=[3, 4])
    assert found.k in (3, 4) and found.scored.count() == feats.count()
    assert cluster(feats, KMEANS, k=3).model.getK() == 3 and cluster(feats, MIXTURE, k=3, max_iter=2).k == 3


def test_dense_vectors_go_to_arrow_without_null_lists(spark):
    from rarebird.functions.columns import vector_parts

    rows = [(Vectors.dense([1.0, 0.0]),), (Vectors.sparse(2, [1], [2.0]),)]
    df = spark.createDataFrame(rows, ["v"])
    got = df.select(vector_parts("v").alias("v")).select("v.*").collect()
    assert [tuple(r) for r in got] == [(1, [], [1.0, 0.0]), (0, [1], [2.0])]
    with SS.packed(df, "v") as blocks:
        assert blocks.sums(lambda x, w: x.sum(0)).tolist() == [1.0, 2.0]


def test_large_features_are_stored_as_large_as_in_memory(spark, monkeypatch):
    """Findings 7, 13 and 14: a scan is cut by the bytes of its files, so few distinct values must not shrink them."""
    import glob
    import os

    from pyspark.ml.feature import VectorAssembler

    from rarebird.operators import layout
    from rarebird.plans import jobs

    monkeypatch.setattr(layout, "PLAIN_BYTES", 200_000 * 3 * 8)
    df = spark.range(200_000).selectExpr("id", "cast(id % 3 AS double) AS x", "cast(id % 5 AS double) AS y")
    _, frame, where = jobs.fit_features(df, [VectorAssembler(inputCols=["x", "y"], outputCol="features")], "id")
    size = sum(os.path.getsize(f) for f in glob.glob(where.removeprefix("file:") + "/*.parquet"))
    assert frame.count() == 200_000 and size > 200_000 * 3 * 8


def test_passes_send_packed_rows_as_they_are(spark, feats):
    """F1, F2 and F3 of round 4: a pass over a large frame moves no column of ones and cuts it into few tasks."""
    rows = [tuple(r.features) for r in feats.select("features").collect()]
    with SS.packed(feats) as blocks:
        assert not blocks.weighted and blocks.width == len(rows[0])
        assert sum(len(v) for v in blocks.values.collect()) == 8 * blocks.width * len(rows)
        assert np.allclose(blocks.sums(lambda x, w: np.append(w.sum(), x.sum(0))), [len(rows), *np.sum(rows, axis=0)])
    with SS.packed(feats.withColumn("w", F.col("id") * 0 + 2), weight="w") as blocks:
        assert blocks.weighted and blocks.sums(lambda x, w: np.array([w.sum(), x.shape[1]]).reshape(-1))[0] == 2 * len(rows)
    assert [SS._tasks_for(n) for n in (0, 1, 40 << 20, 300 << 20, 1800 << 20)] == [1, 1, 10, 24, 75]


def test_starts_of_all_candidates_are_read_at_once(spark, feats):
    """They are the rows that Spark's sample takes, for frames with an exchange too."""
    def sampled(df, k):
        drawn = df.select("features")._jdf.rdd().takeSample(True, 5 * k, 123)
        return np.array([list(r.get(0).toArray()) for r in drawn]).reshape(k, 5, -1).mean(1)

    for df in (feats, feats.select("id", "features").repartition(5, "id")):
        for k, m in zip((2, 4), SS.starts(df, "features", [2, 4], 123)):
            assert m.k == k and np.array_equal(m.means, sampled(df, k))


def test_densities_of_far_components_vanish_beside_the_smallest(spark):
    """Rows far from a component meet no numbers below the normal ones, and keep the density they had."""
    near, far = SS.Mixture(1, np.ones(1), np.zeros((1, 2)), np.eye(2)[None]), SS.Mixture(1, np.ones(1), np.full((1, 2), 27.0), np.eye(2)[None])
    x = np.vstack([np.random.default_rng(1).standard_normal((2, 50)), np.ones(50)])
    p = SS._Densities([near, far])(x)
    assert np.allclose(p[0], np.exp(-(x[:2] ** 2).sum(0) / 2) / (2 * np.pi)) and (p[1] == SS._EPSILON).all()
    assert SS._VANISHED > np.log(np.finfo(float).tiny) and np.exp(SS._VANISHED) + SS._EPSILON == SS._EPSILON
