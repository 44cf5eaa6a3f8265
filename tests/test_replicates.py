"""Bootstrap replicates as row weights against resampled rows."""

import numpy as np
import pytest
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from rarebird.operators import shared_search as SS
from rarebird.operators.sampling import replicate_weights
from rarebird.operators.wide import BlockPCA, standardizer
from rarebird.plans import jobs


@pytest.fixture(scope="module")
def weighted(spark):
    rng = np.random.default_rng(4)
    rows = [(i, Vectors.dense(rng.standard_normal(4) * [1, 5, 2, 9] + (i % 3) * 8)) for i in range(400)]
    df = spark.createDataFrame(rows, ["id", "raw"]).repartition(4)
    return replicate_weights(df, "id", 1, 1.0, 9, "w").persist()


def repeated(weighted):
    return weighted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("w").cast("int"))))


def test_weights_repeat_under_any_layout_and_differ_by_replicate(spark):
    df = spark.range(5000)
    draw = lambda d, r: {x.id: x.weight for x in replicate_weights(d, "id", r, 0.5, 3).collect()}
    a = draw(df, 0)
    assert a == draw(df.repartition(11), 0) and a != draw(df, 1)
    assert abs(sum(a.values()) - 2500) < 6 * 2500**0.5 and max(a.values()) >= 3


def test_scaler_and_components_equal_those_of_repeated_rows(weighted):
    copies = repeated(weighted)
    ours = standardizer(weighted, 4, "raw", "scaled", "w", True)
    own = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True).fit(copies)
    assert np.allclose(ours.mean, own.mean) and np.allclose(ours.std, own.std)
    a = BlockPCA(2, "scaled", "f", weight="w").fit(ours.transform(weighted))
    b = PCA(k=2, inputCol="scaled", outputCol="f").fit(own.transform(copies))
    assert np.allclose(np.abs(a.pc.toArray()), np.abs(b.pc.toArray())) and np.allclose(a.explainedVariance, b.explainedVariance)


def test_weighted_mixtures_equal_sparks(weighted):
    feats = weighted.withColumnRenamed("raw", "features")
    own = GaussianMixture(k=3, seed=7, weightCol="w", maxIter=15).fit(feats)
    m = SS.start(feats, "features", 3, 7, "w")
    with SS.packed(feats, weight="w") as blocks:
        SS.fit_mixtures(blocks, [m], 15)
    assert m.log_likelihood == pytest.approx(own.summary.logLikelihood, rel=1e-9) and np.allclose(m.weights, own.weights)
    km = KMeans(k=3, seed=7, weightCol="w", featuresCol="features").fit(feats)
    one, both = km.transform(feats), km.transform(repeated(feats))
    assert SS.silhouettes(both, ["prediction"])[0] is not None and one.count() < both.count()


def test_replicates_report_what_they_fitted(spark):
    df = spark.range(3000).selectExpr("id % 1000 AS id", "cast(id % 3 AS string) AS c", "100.0 * (id % 3) + pmod(id * 7, 5) AS x")
    base = jobs.replicate_frame(spark, df, ["c"], "id")
    first, again = ([(r.metrics.collect(), sorted(map(tuple, r.result.collect()))) for r in jobs.bootstrap_segment_replicates(
        spark, base, None, "id", [0, 1], k=3, seed=5, moment="m")] for _ in range(2))
    assert first == again and first[0] != first[1]
    for metrics, rows in first:
        n = len(rows)
        shares = sorted(100 * sum(p == c for _, p in rows) / n for c in range(3))
        assert sorted(m.valor_indicador for m in metrics) == pytest.approx(shares, rel=1e-5)
    # rows of one id lie at several places, and are drawn apart
    drawn = {r.id: r.n for r in replicate_weights(base.frame, jobs.PLACE, 0, 1.0, 5).groupBy("id").agg(F.collect_set("weight").alias("n")).collect()}
    assert any(len(v) > 1 for v in drawn.values())
    a = jobs.bootstrap_anomalies(spark, df, ["c"], "id", k=3, pca_k=2, max_iter=5)
    assert 0.3 * 3000 < a.result.count() < 0.7 * 3000 and a.result.columns == ["id", "prediction", "probability", "anomalies"]
    model_rows = a.model.transform(df.limit(10)).count()
    assert model_rows == 10
    with pytest.raises(ValueError):
        jobs.replicate_frame(spark, df.drop("c").limit(0), None, "id")


def test_a_draw_is_made_once_for_its_fit(spark, monkeypatch):
    """Findings 1 to 4: start, rounds, silhouette and shares read kept features, which are released after;
    what is reported later are the same rows."""
    df = spark.range(600).selectExpr("id", "100.0 * (id % 3) + pmod(id * 7, 5) AS x", "cast(pmod(id * 13, 11) AS double) AS y")
    base = jobs.replicate_frame(spark, df, None, "id")
    seen, clustered = [], jobs.cluster

    def watched(feats, *args, **params):
        seen.append((feats, feats.storageLevel.useMemory))
        return clustered(feats, *args, **params)

    monkeypatch.setattr(jobs, "cluster", watched)
    [report] = jobs.bootstrap_anomaly_replicates(spark, base, None, "id", [0], k=3, pca_k=2, seed=3, max_iter=3, moment="m")
    [(feats, kept)] = seen
    assert kept and not feats.storageLevel.useMemory
    drawn = replicate_weights(base.frame, jobs.PLACE, 0, 0.5, 3).agg(F.sum("weight")).first()[0]
    assert report.result.count() == drawn == sum(r.n for r in report.result.groupBy("id").agg(F.count("*").alias("n")).collect())


def test_the_hash_of_a_draw_is_taken_once_a_row(spark):
    df = replicate_weights(spark.range(5), "id", 1, 0.5, 3).select("weight")
    plan = df._jdf.queryExecution().analyzed().toString()
    assert plan.count("md5(") == 1


def test_the_replicates_of_the_job_share_one_frame(spark, scratch_dir, monkeypatch):
    """F2 of round 4: the rows of the table are encoded and written once for both models."""
    from rarebird.plans.registry import QUERIES

    rng = np.random.default_rng(3)
    rows = [(i, 1, *map(float, rng.standard_normal(4) + 9 * (i % 3)), "ANR"[i % 3], "OF"[i % 2]) for i in range(240)]
    names = "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    spark.createDataFrame(rows, names).coalesce(1).write.mode("overwrite").parquet(f"{scratch_dir}/one_frame/lineitem.parquet")
    written, own = [], jobs.fit_features
    monkeypatch.setattr(jobs, "fit_features", lambda *a, **b: written.append(a) or own(*a, **b))
    got = QUERIES["bootstrap_job"](spark, f"{scratch_dir}/one_frame").collect()
    assert len(written) == 1 and {r.modelo for r in got} >= {"anomalias_fricciones_ent", "segmentacion_anomalias_fricciones_ent"}
