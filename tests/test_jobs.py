import os

import pytest
from rarebird.plans import jobs
from rarebird.plans.registry import lineitem
from rarebird.sources import models as S_models

SF = "/root/testdata/sf0.001"
MOMENT = "01/01/2024 00:00:00"


@pytest.fixture(scope="module")
def li(spark):
    return lineitem(spark, SF)


def test_anomaly_train_then_predict(spark, li, scratch_dir):
    path = os.path.join(scratch_dir, "anomaly_pipeline")
    rep = jobs.train_anomaly_model(
        spark, li, "l_returnflag,l_linestatus", "line_id", metric_table="rb_mon_anom",
        pipeline_path=path, exit_table="rb_anom_train", ks=[3, 4], moment=MOMENT, max_iter=20,
    )
    assert rep.k in (3, 4) and rep.silhouette is not None
    result = spark.table("rb_anom_train")
    assert [f.dataType.simpleString() for f in result.schema.fields] == ["string", "int", "string", "int"]
    assert result.count() == li.count()  # repeated ids survive
    mon = spark.table("rb_mon_anom").collect()
    shares = [r for r in mon if r.id_indicador == 2]
    assert sum(r.valor_indicador for r in shares) == pytest.approx(100.0, rel=1e-5)
    assert {r.nombre_indicador for r in mon if r.id_indicador == 1} == {"silhouette_score", "numero_clusters"}
    # the flag equals the rule recomputed from the stored memberships
    stored = result.collect()
    for r in stored:
        probs = [float(x) for x in r.probability.strip("[]").split(",")]
        assert r.anomalies == (1 if all(p < 0.7 for p in probs) else 0)

    pred = jobs.predict_anomalies(spark, li, "line_id", pipeline_path=path, exit_table="rb_anom_pred",
                                  metric_table="rb_mon_anom", moment=MOMENT)
    a = sorted(tuple(r) for r in spark.table("rb_anom_pred").collect())
    b = sorted(tuple(r) for r in stored)
    assert a == b  # save -> load -> score gives the same rows
    assert {r.modelo for r in pred.metrics.collect()} == {"anomalias_fricciones_pre"}


def test_failure_appends_one_row_and_raises(spark, scratch_dir):
    cust = spark.read.parquet(f"{SF}/customer.parquet").select("c_custkey", "c_acctbal")
    with pytest.raises(Exception):
        jobs.train_anomaly_model(spark, cust, None, "c_custkey", metric_table="rb_mon_fail", moment=MOMENT)
    rows = spark.table("rb_mon_fail").collect()
    assert len(rows) == 1 and rows[0].ejecucion == 0 and rows[0].valor_indicador is None
    rep = jobs.train_anomaly_model(spark, cust, None, "c_custkey", moment=MOMENT, on_error="record")
    assert rep.error is not None and rep.metrics.count() == 1


def test_missing_query_table_records_failure(spark):
    rep = jobs.predict_segments(spark, "SELECT * FROM rb_no_such_table", "id", pipeline_path="/nonexistent",
                                moment=MOMENT, on_error="record")
    assert rep.error is not None
    assert rep.metrics.first().modelo == "segmentacion_anomalias_fricciones_pre"


def test_segments_train_predict_and_stage_loading(spark, li, scratch_dir):
    path = os.path.join(scratch_dir, "segment_pipeline")
    rep = jobs.train_segments(spark, li, ["l_returnflag", "l_linestatus"], "line_id", pipeline_path=path,
                              metric_table="rb_mon_seg", moment=MOMENT)
    assert rep.k in (3, 4)
    pred = jobs.predict_segments(spark, li, "line_id", exit_table="rb_seg_pred", pipeline_path=path,
                                 metric_table="rb_mon_seg", moment=MOMENT)
    out = spark.table("rb_seg_pred")
    assert out.columns == ["line_id", "prediction"] and out.count() == li.count()
    names = sorted(r.nombre_indicador for r in pred.metrics.collect())
    assert names == [f"anomalias_gf_{i}" for i in range(rep.k)]
    # separate artefacts load with the class-level loaders, nothing fitted
    stages = S_models.stage_models(S_models.load_pipeline(path))
    S_models.save_model(stages["model"], os.path.join(scratch_dir, "km"))
    S_models.save_model(stages["scaler"], os.path.join(scratch_dir, "scaler"))
    model, scaler = S_models.load_models(os.path.join(scratch_dir, "km"), os.path.join(scratch_dir, "scaler"),
                                         family="kmeans")
    assert model.getK() == rep.k and scaler.getWithMean()


def test_bootstraps(spark, li):
    a = jobs.bootstrap_anomalies(spark, li, ["l_returnflag", "l_linestatus"], "line_id", k=3, seed=5,
                                 moment=MOMENT, max_iter=20)
    rows = a.metrics.collect()
    assert sum(r.valor_indicador for r in rows if r.id_indicador == 2) == pytest.approx(100.0, rel=1e-5)
    s = jobs.bootstrap_segments(spark, li, ["l_returnflag", "l_linestatus"], "line_id", k=3, seed=5, moment=MOMENT)
    assert s.metrics.count() == 3


def test_composed_jobs_from_settings(spark, li, scratch_dir):
    li.createOrReplaceTempView("rb_li")
    spark.read.parquet(f"{SF}/orders.parquet").createOrReplaceTempView("rb_orders")
    settings = {
        "tablas_salida": {"exitTable_anomalies_train": "rb_job_anom", "exitTable_anomalies_predict": "rb_job_anom_p",
                          "exitTableSegmentation": "rb_job_seg", "exitTable_resultado_enriquecido_train": "rb_job_enr",
                          "exitTable_resultado_enriquecido_predict": "rb_job_enr_p"},
        "columnas_identificacion": {"anomalias": "line_id", "segmentacion": "order_id"},
        "columnas_categoricas": {"anomalias": "l_returnflag,l_linestatus", "segmentacion": "o_orderpriority"},
        "consultas": {
            "anomalias_entrenamiento": "SELECT * FROM rb_li",
            "anomalias_prediccion": "SELECT * FROM rb_li",
            "cruce_resultado_entrenamiento": (
                "SELECT o.o_orderkey AS order_id, o.o_totalprice, o.o_orderpriority, a.anomalies "
                "FROM rb_job_anom a JOIN rb_li l ON a.line_id = CAST(l.line_id AS STRING) "
                "JOIN rb_orders o ON CAST(FLOOR(l.line_id / 8) AS BIGINT) = o.o_orderkey"),
            "cruce_resultado_prediccion": (
                "SELECT o.o_orderkey AS order_id, o.o_totalprice, o.o_orderpriority, a.anomalies "
                "FROM rb_job_anom_p a JOIN rb_li l ON a.line_id = CAST(l.line_id AS STRING) "
                "JOIN rb_orders o ON CAST(FLOOR(l.line_id / 8) AS BIGINT) = o.o_orderkey"),
            "segmentacion_entrenamiento": "SELECT * FROM rb_job_enr",
            "segmentacion_prediccion": "SELECT * FROM rb_job_enr_p",
        },
        "threshold": "0.7",
        "modelos": {"anomalias": os.path.join(scratch_dir, "a"), "segmentacion": os.path.join(scratch_dir, "s")},
        "tablas_monitoreo": {"monitoring_anomalies": "rb_job_mon_a", "monitoring_segmentation": "rb_job_mon_s"},
    }
    train_cfg = jobs.JobConfig.from_mapping(settings, "train")
    rep = jobs.training_job(spark, train_cfg, moment=MOMENT, anomaly_params={"max_iter": 20, "pca_k": 5, "max_k": 4},
                            segment_params={"max_iter": 10, "max_k": 3})
    assert rep.anomalies.error is None and rep.segments.error is None
    enriched = spark.table("rb_job_enr")
    assert enriched.count() == enriched.select("order_id").distinct().count()
    pred = jobs.prediction_job(spark, jobs.JobConfig.from_mapping(settings, "predict"), moment=MOMENT)
    assert pred.anomalies.error is None and pred.segments.error is None
    assert spark.table("rb_job_seg").count() == spark.table("rb_job_enr_p").count()


def test_settings_carry_the_dedupe_order():
    from collections import defaultdict

    layout = {k: defaultdict(str) for k in ("tablas_salida", "columnas_identificacion", "columnas_categoricas", "consultas", "modelos",
                                            "tablas_monitoreo")}
    assert jobs.JobConfig.from_mapping(layout).dedupe_order is None
    assert jobs.JobConfig.from_mapping(layout | {"dedupe_order": "-amount,id"}).dedupe_order == ["-amount", "id"]


def test_metrics_and_result_outlive_the_run(spark, li):
    from rarebird.session import checkpoint_dir

    rep = jobs.train_segments(spark, li, ["l_returnflag", "l_linestatus"], "line_id", ks=[3], moment=MOMENT)
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(checkpoint_dir(spark) + "/rarebird")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    left = [x.getPath().getName() for x in fs.listStatus(root)] if fs.exists(root) else []
    assert not [x for x in left if x.startswith("features-")]
    assert rep.result.count() == li.count() and not rep.skipped
    assert abs(sum(r.valor_indicador for r in rep.metrics.collect()) - 100.0) < 1e-3


def test_saved_pipeline_scoring_plan_is_narrow(spark, li, scratch_dir):
    """Loaded prep + mixture + flag: one narrow stage - no exchange, join, window or Python."""
    from rarebird.operators.anomaly import flag_anomalies, stored_result
    from rarebird.operators.features import drop_incomplete

    path = os.path.join(scratch_dir, "p")
    jobs.train_anomaly_model(spark, li, ["l_returnflag", "l_linestatus"], "line_id", pipeline_path=path, ks=[3],
                             moment=MOMENT, max_iter=5)
    raw = spark.read.parquet(f"{SF}/lineitem.parquet").selectExpr(
        "l_orderkey * 8 + l_linenumber AS line_id", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus")
    scored = stored_result(flag_anomalies(S_models.load_pipeline(path).transform(drop_incomplete(raw)), "line_id"),
                           "line_id")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    for word in ("Exchange", "Join", "Window", "BatchEvalPython", "ArrowEvalPython", "SinglePartition"):
        assert word not in plan, word


def test_k_for_query_family_defaults(spark):
    from rarebird.operators.clustering import k_for_query

    spark.read.parquet(f"{SF}/customer.parquet").createOrReplaceTempView("rb_k_customer")
    k = k_for_query(spark, "SELECT c_custkey, c_acctbal, c_nationkey, c_mktsegment FROM rb_k_customer",
                    ["c_mktsegment"], "c_custkey", family="kmeans")
    assert 3 <= k <= 6


def test_command_line_runner(spark, li, scratch_dir):
    import json

    from rarebird.plans.run import main

    li.createOrReplaceTempView("rb_cli_li")
    cross = ("SELECT CAST(FLOOR(l.line_id / 8) AS BIGINT) AS order_id, l.l_quantity, a.anomalies FROM {t} a "
             "JOIN rb_cli_li l ON a.line_id = CAST(l.line_id AS STRING)")
    settings = {"parametros_modelo": {
        "tablas_salida": {"exitTable_anomalies_train": "rb_cli_anom", "exitTable_anomalies_predict": "rb_cli_anom_p",
                          "exitTableSegmentation": "rb_cli_seg", "exitTable_resultado_enriquecido_train": "rb_cli_enr",
                          "exitTable_resultado_enriquecido_predict": "rb_cli_enr_p"},
        "columnas_identificacion": {"anomalias": "line_id", "segmentacion": "order_id"},
        "columnas_categoricas": {"anomalias": "l_returnflag,l_linestatus", "segmentacion": ""},
        "consultas": {"anomalias_entrenamiento": "SELECT * FROM rb_cli_li",
                      "anomalias_prediccion": "SELECT * FROM rb_cli_li",
                      "cruce_resultado_entrenamiento": cross.format(t="rb_cli_anom"),
                      "cruce_resultado_prediccion": cross.format(t="rb_cli_anom_p"),
                      "segmentacion_entrenamiento": "SELECT * FROM rb_cli_enr",
                      "segmentacion_prediccion": "SELECT * FROM rb_cli_enr_p"},
        "threshold": "0.7",
        "modelos": {"anomalias": os.path.join(scratch_dir, "a"), "segmentacion": os.path.join(scratch_dir, "s")},
        "tablas_monitoreo": {"monitoring_anomalies": "rb_cli_mon_a", "monitoring_segmentation": "rb_cli_mon_s"},
    }}
    path = os.path.join(scratch_dir, "settings.json")
    with open(path, "w") as fh:
        json.dump(settings, fh)
    root = os.path.join(scratch_dir, "tables")
    assert main(["train", path, "--table-root", root]) == 0
    assert main(["predict", path, "--table-root", root]) == 0
    assert spark.table("rb_cli_seg").count() == spark.table("rb_cli_enr_p").count()
    assert os.path.isdir(os.path.join(root, "rb_cli_mon_a"))


def test_width_guard_refuses_huge_pca(spark, monkeypatch):
    from rarebird.operators.features import preparation_stages

    df = spark.range(2000).selectExpr("id", "cast(id % 50 AS string) AS c", "cast(id AS double) AS x")
    stages = preparation_stages(df.columns, ["c"], "id", pca_k=2)
    with pytest.raises(ValueError):
        jobs.fit_features(df, stages, "id", max_width=20)
    ok = preparation_stages(df.columns, ["c"], "id", pca_k=None)
    prep, feats, folder = jobs.fit_features(df, ok, "id", max_width=51)
    assert feats.count() == 2000
    jobs.remove_path(spark, folder)
