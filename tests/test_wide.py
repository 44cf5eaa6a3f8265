"""Wide preparation against the indexer, the encoder and Spark's PCA on widths that both can do."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from rarebird.operators import features as FT
from rarebird.operators import wide as W
from rarebird.plans import jobs
from rarebird.sources.models import stage_models

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lines(spark):
    raw = spark.read.parquet(f"{SF}/lineitem.parquet")
    return raw.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line_id"), "l_quantity", "l_extendedprice",
                      "l_returnflag", F.col("l_suppkey").cast("string").alias("supp"), F.col("l_partkey").alias("part")).persist()


def as_rows(frame, id_col="line_id"):
    return {r[id_col]: np.array(r.v) for r in frame.select(id_col, vector_to_array("features").alias("v")).collect()}


def test_labels_rank_as_the_indexer_does(spark):
    odd = ["", " ", "a", "A", "é", "z", "10", "9", "", "\U0001f600", "ab", "a\x00"]
    rows = [(v, str(k % 3)) for k, v in enumerate(odd) for _ in range(1 + k % 4)] + [(None, "x"), ("a", None)]
    df = spark.createDataFrame(rows * 3, "s string, t string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # labels of one column in many partitions
    try:
        got = W.category_table(df, ["s", "t"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    model = FT.category_indexer(["s", "t"]).fit(df.na.drop())
    whole = {c: FT.category_indexer([c]).fit(df.select(c).na.drop()) for c in ("s", "t")}
    for c in ("s", "t"):
        ranked = sorted((r for r in got if r.column_name == c), key=lambda r: r.category_index)
        assert [r.category_index for r in ranked] == list(range(len(ranked)))
        assert [r.label for r in ranked] == list(whole[c].labelsArray[0])
    assert model is not None
    assert W.category_table(df.where("false"), ["s"]).count() == 0


def test_wide_encoding_equals_one_hot(spark, lines):
    cats = ["l_returnflag", "supp", "part"]
    narrow = as_rows(FT.inference_features(lines, cats, "line_id", wide=False))
    wide = as_rows(FT.inference_features(lines, cats, "line_id", wide=True))
    assert narrow.keys() == wide.keys() and all((narrow[k] == wide[k]).all() for k in narrow)


def test_rare_labels_meet_the_table_in_a_join(spark, lines, monkeypatch):
    monkeypatch.setattr(W, "HEAD_LABELS", 3)
    model = W.WideAssembler(["l_quantity"], ["supp", "part"], "features").fit(lines)
    assert model.heads == {"supp": 3, "part": 3}
    score = lines.limit(50).unionByName(lines.limit(3).withColumn("supp", F.lit("none")).withColumn("part", F.lit(None).cast("long")))
    plain = FT.preparation_pipeline(["line_id", "l_quantity", "supp", "part"], ["supp", "part"], "line_id", scale=None).fit(
        lines.select("line_id", "l_quantity", "supp", "part"))
    got = sorted((r.line_id, r.supp, tuple(r.v)) for r in model.transform(score).select("line_id", "supp", vector_to_array("features").alias("v")).collect())
    unseen = score.fillna({"part": -1})
    want = sorted((r.line_id, r.supp, tuple(r.v)) for r in plain.transform(unseen).select("line_id", "supp", vector_to_array("features").alias("v")).collect())
    assert got == want


def aligned(a, b):
    """Largest difference of two sets of rows of components, either sign of each component."""
    keys = sorted(a)
    x, y = np.array([a[k] for k in keys]), np.array([b[k] for k in keys])
    return float(np.abs(x * np.sign((x * y).sum(0)) - y).max())


def test_wide_components_equal_dense_ones(spark, lines, monkeypatch):
    monkeypatch.setattr(W, "SMALL_WIDTH", 0)
    ids = lines.dropDuplicates(["line_id"])
    narrow = FT.prepare(ids, ["l_returnflag", "supp"], "line_id", pca_k=4, wide=False)
    wide = FT.prepare(ids, ["l_returnflag", "supp"], "line_id", pca_k=4, wide=True)
    assert aligned(as_rows(wide.frame), as_rows(narrow.frame)) < 1e-6
    a, b = stage_models(narrow.model)["pca"], stage_models(wide.model)["pca"]
    assert np.allclose(a.explainedVariance.toArray(), b.explainedVariance.toArray(), atol=1e-10)


@pytest.mark.parametrize("width,k", [(3, 3), (40, 5), (120, 1)])
@pytest.mark.parametrize("whole", [0, 64])
def test_block_components_equal_spark_pca_on_any_vectors(spark, monkeypatch, width, k, whole):
    monkeypatch.setattr(W, "SMALL_WIDTH", whole)
    rng = np.random.default_rng(width)
    data = rng.standard_normal((200, width)) * (1 + np.arange(width)) ** 0.7 + 1000
    data[:, ::3] *= rng.random((200, len(range(0, width, 3)))) < 0.1
    vectors = [Vectors.dense(r) if i % 2 else Vectors.sparse(width, [(j, float(x)) for j, x in enumerate(r) if x]) for i, r in enumerate(data)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], ["i", "v"]).repartition(3)
    dense = PCA(k=k, inputCol="v", outputCol="features").fit(df)
    est = W.BlockPCA(k, "v", "features")
    block = est.fit(df)
    assert np.allclose(np.abs((dense.pc.toArray() * block.pc.toArray()).sum(0)), 1.0, atol=1e-9)
    assert np.allclose(dense.explainedVariance.toArray(), block.explainedVariance.toArray(), atol=1e-9)
    assert aligned(as_rows(block.transform(df), "i"), as_rows(dense.transform(df), "i")) < 1e-5


def test_large_products_leave_tasks_in_parts(spark, monkeypatch):
    monkeypatch.setattr(W, "_TASK_CELLS", 10)
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(Vectors.dense(r),) for r in rng.standard_normal((50, 8))], ["v"])
    frame = df.repartition(4)
    x = np.array([r.v.toArray() for r in df.collect()])
    n, mean, variance = W.slot_moments(frame, 8)
    block = rng.standard_normal((8, 3))
    assert n == 50 and np.allclose(mean, x.mean(0)) and np.allclose(variance, x.var(0, ddof=1))
    assert np.allclose(W.covariance_times(frame, mean, n, block), np.cov(x.T) @ block)


def test_a_width_refused_before_trains_scores_saves_and_loads(spark, scratch_dir, monkeypatch):
    """More labels than the driver is said to hold: the anomaly job takes the wide form by itself."""
    df = spark.range(3000).selectExpr("id", "cast(id % 700 AS string) AS code", "cast(pmod(id * 7919, 101) AS double) AS x",
                                      "IF(id % 2 = 0, 500.0, 0.0) + pmod(id * 31, 17) AS y")
    stages = FT.preparation_stages(df.columns, ["code"], "id", pca_k=2)
    monkeypatch.setattr(FT, "driver_memory", lambda _: 1 << 20)
    with pytest.raises(FT.TooWide):
        FT.check_width(df, stages)
    path = f"{scratch_dir}/wide"
    report = jobs.train_anomaly_model(spark, df, ["code"], "id", pipeline_path=path, ks=[3], pca_k=2, max_iter=5)
    assert report.error is None and report.result.count() == 3000
    loaded = PipelineModel.load(path)
    again = jobs.predict_anomalies(spark, df, "id", pipeline_path=path)
    a = {r.id: (r.prediction, r.anomalies) for r in report.result.collect()}
    assert a == {r.id: (r.prediction, r.anomalies) for r in again.result.collect()}
    assert stage_models(loaded)["assembler"].width == 702 and "centring" in stage_models(loaded)
    with pytest.raises(ValueError):
        jobs.train_anomaly_model(spark, df, ["code"], "id", ks=[3], pca_k=2, max_width=100)


def test_segments_of_wide_rows_equal_those_of_narrow_ones(spark):
    df = spark.range(600).selectExpr("id", "cast(id % 3 AS string) AS code", "100.0 * (id % 3) + pmod(id, 7) AS x")
    shares = [sorted(r.valor_indicador for r in jobs.train_segments(spark, df, ["code"], "id", ks=[3], wide=w).metrics.collect())
              for w in (False, True)]
    assert shares[0] == shares[1]


def test_sums_work_on_few_entries_at_a_time(spark, monkeypatch):
    """Finding 9: a wide batch is worked off in slices, dense rows without an index per entry."""
    monkeypatch.setattr(W, "_SLICE_CELLS", 20)
    rng = np.random.default_rng(2)
    data = rng.standard_normal((60, 7))
    data[::2, 3:] = 0
    block = rng.standard_normal((7, 2))
    dense = [Vectors.dense(r) for r in data]
    mixed = [Vectors.sparse(7, list(enumerate(r[:3]))) if i % 2 == 0 else v for i, (r, v) in enumerate(zip(data, dense))]
    for vectors in (dense, mixed):
        frame = spark.createDataFrame([(v, float(i % 3)) for i, v in enumerate(vectors)], ["v", "w"]).repartition(3)
        w = np.arange(60) % 3
        n, mean, variance = W.slot_moments(frame, 7, weighted=True)
        assert n == w.sum() and np.allclose(mean, w @ data / n) and np.allclose(variance, w @ (data - mean) ** 2 / (n - 1))
        want = ((data - mean) * w[:, None]).T @ (data - mean) / (n - 1)
        assert np.allclose(W.covariance_times(frame, mean, n, block, weighted=True), want @ block)
    monkeypatch.setattr(W, "_rows", None)  # no entry of dense rows is numbered
    W.slot_moments(spark.createDataFrame([(v,) for v in dense], ["v"]), 7)
