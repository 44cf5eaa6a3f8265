import pytest

from rarebird.operators import metrics as M


def test_class_share_sums_to_100_and_sorted(spark):
    df = spark.createDataFrame([(c,) for c in "aaabbc"], "k string")
    rows = M.class_share(df, "k").collect()
    assert [r.k for r in rows] == ["a", "b", "c"]
    assert sum(r.valor_indicador for r in rows) == pytest.approx(100.0)
    assert rows[0].valor_indicador == pytest.approx(50.0)


def test_segment_rows_named_by_ascending_share_ties_by_id(spark):
    df = spark.createDataFrame([(p,) for p in [0, 0, 1, 2, 2, 2]], "prediction int")
    shares = M.class_share(df, "prediction")
    rows = {r.nombre_indicador: r for r in M.segment_metric_rows(shares, "01/01/2024 00:00:00").collect()}
    assert rows["anomalias_gf_0"].valor_indicador == pytest.approx(100 / 6, rel=1e-6)
    assert rows["anomalias_gf_1"].valor_indicador == pytest.approx(200 / 6, rel=1e-6)
    assert rows["anomalias_gf_2"].valor_indicador == pytest.approx(50.0)
    assert {r.modelo for r in rows.values()} == {"segmentacion_anomalias_fricciones_ent"}


def test_anomaly_rows(spark):
    df = spark.createDataFrame([(f,) for f in [0, 0, 0, 1]], "anomalies int")
    rows = M.anomaly_metric_rows(M.class_share(df, "anomalies"), "m", "predict").collect()
    assert {(r.nombre_indicador, r.valor_indicador) for r in rows} == {("anomalias_gf_0", 75.0), ("anomalias_gf_1", 25.0)}
    assert all(r.modelo == "anomalias_fricciones_pre" and r.ejecucion == 1 and r.id_indicador == 2 for r in rows)


def test_model_rows_and_failure_row(spark):
    rows = M.model_metric_rows(spark, 0.5, 4, "m").collect()
    assert [(r.nombre_indicador, r.valor_indicador, r.id_indicador) for r in rows] == [
        ("silhouette_score", 0.5, 1), ("numero_clusters", 4.0, 1)]
    none = M.model_metric_rows(spark, None, 3, "m").collect()
    assert none[0].valor_indicador is None
    fail = M.failure_row(spark, "segment", "predict", "m").collect()
    assert len(fail) == 1 and fail[0].ejecucion == 0 and fail[0].valor_indicador is None
    assert fail[0].nombre_indicador == "anomalias_gf_0"
    assert M.failure_row(spark, "anomaly", "train", "m").first().nombre_indicador == "anomalias_gf_1"


def test_monitoring_schema_order(spark):
    df = M.monitoring_union([M.failure_row(spark, "anomaly", "train", "m")])
    assert tuple(df.columns) == M.MONITORING_COLUMNS
    assert dict(df.dtypes)["valor_indicador"] == "float"


def test_share_plan_is_one_aggregation(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k")
    plan = M.class_share(df, "k")._jdf.queryExecution().executedPlan().toString()
    # partial aggregation before the shuffle; the window works on the grouped rows only
    assert plan.count("HashAggregate") >= 2
