import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from rarebird.operators.clustering import (
    KMEANS,
    MIXTURE,
    choose_k,
    cluster,
    model_k,
    segment_prediction,
    silhouette,
)


def _blobs(spark, centres=((0, 0), (10, 0), (0, 10)), per=40, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    i = 0
    for cx, cy in centres:
        for _ in range(per):
            rows.append((i, Vectors.dense([cx + rng.normal(0, 0.5), cy + rng.normal(0, 0.5)])))
            i += 1
    return spark.createDataFrame(rows, ["id", "features"])


def test_silhouette_singleton_cluster(spark):
    df = spark.createDataFrame(
        [(Vectors.dense([1.0]), 0.0), (Vectors.dense([2.0]), 0.0), (Vectors.dense([9.0]), 1.0)],
        ["features", "prediction"],
    )
    assert silhouette(df) == pytest.approx(0.654656, abs=1e-6)


def test_silhouette_one_cluster_raises(spark):
    df = spark.createDataFrame([(Vectors.dense([1.0]), 0.0), (Vectors.dense([2.0]), 0.0)], ["features", "prediction"])
    with pytest.raises(Exception):
        silhouette(df)


def test_choose_k_kmeans_finds_three_blobs(spark):
    df = _blobs(spark)
    search = choose_k(df, KMEANS, max_k=5)
    assert search.k == 3
    assert search.model is not None and model_k(search.model) == 3
    assert search.silhouette == max(s for s in search.scores.values() if s is not None)
    assert set(search.scores) == {3, 4, 5}


def test_choose_k_parallel_equals_sequential(spark):
    df = _blobs(spark)
    a = choose_k(df, KMEANS, max_k=5, parallelism=1)
    b = choose_k(df, KMEANS, max_k=5, parallelism=3)
    assert a.scores == b.scores and a.k == b.k


def test_choose_k_skips_failing_candidates(spark):
    # two distinct points: every k >= 3 leaves at most two used clusters; k=1 fails silhouette
    df = spark.createDataFrame([(i, Vectors.dense([float(i % 2)])) for i in range(6)], ["id", "features"])
    search = choose_k(df, KMEANS, ks=[1, 2])
    assert search.scores[1] is None and 1 in search.errors
    assert search.k == 2


def test_choose_k_all_fail_defaults_to_three(spark):
    df = spark.createDataFrame([(i, Vectors.dense([1.0])) for i in range(5)], ["id", "features"])
    search = choose_k(df, KMEANS, ks=[3, 4])
    assert search.k == 3 and search.silhouette is None and search.model is None


def test_choose_k_empty_input_raises(spark):
    df = spark.createDataFrame([], "id int, features vector") if False else _blobs(spark).limit(0)
    with pytest.raises(ValueError):
        choose_k(df, KMEANS, max_k=4)


def test_kmeans_rows_at_nearest_centre(spark):
    df = _blobs(spark)
    res = cluster(df, KMEANS, k=3)
    centres = [np.array(c) for c in res.model.clusterCenters()]
    for r in res.scored.select("features", "prediction").collect():
        d = [float(np.sum((r.features.toArray() - c) ** 2)) for c in centres]
        assert r.prediction == int(np.argmin(d))


def test_mixture_memberships_sum_to_one_and_rows_kept(spark):
    df = _blobs(spark).union(_blobs(spark).limit(5))  # repeated ids
    res = cluster(df, MIXTURE, k=3)
    rows = res.scored.select("id", vector_to_array("probability").alias("p"), "prediction").collect()
    assert len(rows) == df.count()
    for r in rows:
        assert math.isclose(sum(r.p), 1.0, abs_tol=1e-9)
        assert r.prediction == int(np.argmax(r.p))


def test_cluster_search_reuses_winner(spark):
    df = _blobs(spark)
    res = cluster(df, KMEANS, k=0, max_k=4)
    assert res.search is not None and res.model is res.search.model
    assert res.silhouette == res.search.silhouette


def test_trained_model_branch(spark):
    df = _blobs(spark)
    first = cluster(df, KMEANS, k=3)
    again = cluster(df, trained_model=first.model)
    assert again.k == 3
    assert again.silhouette == pytest.approx(first.silhouette)


def test_segment_prediction_columns(spark):
    out = segment_prediction(_blobs(spark), "id", k=3)
    assert out.columns == ["id", "prediction"]
    assert dict(out.dtypes)["prediction"] == "int"


def test_layout_goes_by_bytes(spark):
    from rarebird.operators import layout

    assert [layout.partitions_for(n) for n in (0, 1, 5 << 20, 200 << 20, 1 << 40)] == [1, 1, 5, 64, 8192]
    many = spark.range(0, 4000, 1, 4000)  # more splits than bytes call for, on few cores: never merged
    assert layout.spread(many).rdd.getNumPartitions() == 4000
    one = spark.range(0, 400_000, 1, 1)
    assert layout.spread(one).rdd.getNumPartitions() == layout.partitions_for(layout.plan_bytes(one)) > 1
    assert layout.spread(one, 7).rdd.getNumPartitions() == 7
    named = spark.range(3).withColumnRenamed("id", "Exchange")
    assert not layout.has_exchange(named) and layout.has_exchange(named.repartition(2))


def test_a_lost_candidate_fails_the_search(spark, monkeypatch):
    import rarebird.operators.clustering as C

    plain = C.silhouette

    def dies(scored, features="features", **more):
        if scored.select("prediction").distinct().count() == 3:
            raise RuntimeError("stage lost")
        return plain(scored, features=features, **more)

    def all_die(*_, **__):
        raise RuntimeError("stage lost")

    monkeypatch.setattr(C, "silhouette", dies)
    monkeypatch.setattr(C, "silhouettes", all_die)
    for shared in (False, True):
        with pytest.raises(RuntimeError):
            choose_k(_blobs(spark), KMEANS, max_k=5, shared=shared)


def test_vectors_are_laid_out_by_their_own_bytes(spark, scratch_dir):
    from pyspark.ml.functions import array_to_vector

    from rarebird.operators.layout import spread, spread_rows

    same = spark.range(0, 400_000, 1, 1).select("id", array_to_vector(F.array(*[F.lit(1.0)] * 4)).alias("features"))
    same.select("features").write.parquet(f"{scratch_dir}/v")
    stored = spark.read.parquet(f"{scratch_dir}/v").coalesce(1)
    assert spread_rows(stored, 32).rdd.getNumPartitions() == 13  # 12.8 MB of doubles in a few kB of file
    assert spread(stored).rdd.getNumPartitions() <= 2


def test_layout_never_runs_a_shuffle_to_count(spark):
    from rarebird.operators.layout import spread

    tracker = spark.sparkContext.statusTracker()
    shuffled = spark.range(0, 1000, 1, 3).groupBy((F.col("id") % 7).alias("k")).count()
    group = "layout-probe"
    spark.sparkContext.setJobGroup(group, "layout")
    try:
        spread(shuffled)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert tracker.getJobIdsForGroup(group) == []


def test_scoring_is_narrow(spark):
    df = _blobs(spark)
    res = cluster(df, MIXTURE, k=3, with_silhouette=False)
    plan = res.scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
