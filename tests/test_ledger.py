"""Run ledger: repeated and resumed runs of the composed jobs."""

import pytest
from pyspark.sql import functions as F

from rarebird.plans import jobs
from rarebird.sources.ledger import RunLedger, append_once


def config(scratch_dir, mark, **more):
    base = dict(
        anomaly_query=f"SELECT * FROM rb_led_{mark}", anomaly_id="id", anomaly_categorical=[], segment_query=f"SELECT * FROM rb_led_enr_{mark}",
        segment_id="id", segment_categorical=[], enrich_query=f"SELECT l.* FROM rb_led_anom_{mark} a JOIN rb_led_{mark} l ON a.id = CAST(l.id AS STRING)",
        anomaly_pipeline=f"{scratch_dir}/a", segment_pipeline=f"{scratch_dir}/s", anomaly_exit_table=f"rb_led_anom_{mark}",
        enriched_table=f"rb_led_enr_{mark}", segment_exit_table=f"rb_led_seg_{mark}", anomaly_metric_table=f"rb_led_mon_a_{mark}",
        segment_metric_table=f"rb_led_mon_s_{mark}", table_root=f"{scratch_dir}/t", ledger_table=f"rb_led_runs_{mark}")
    return jobs.JobConfig(**(base | more))


def rows_of(spark, mark):
    spark.range(240).selectExpr("id", "10.0 * (id % 3) + pmod(id * 7, 5) / 10 AS x", "10.0 * (id % 3) + pmod(id * 11, 7) / 10 AS y").createOrReplaceTempView(f"rb_led_{mark}")


PARAMS = dict(anomaly_params={"pca_k": 2, "ks": [3], "max_iter": 5}, segment_params={"ks": [3]})


def test_a_repeated_run_appends_nothing_twice_and_keeps_its_moment(spark, scratch_dir):
    rows_of(spark, "r")
    cfg = config(scratch_dir, "r")
    jobs.training_job(spark, cfg, moment="m1", run_id="one", on_error="raise", **PARAMS)
    counts = lambda: [spark.table(t).count() for t in ("rb_led_mon_a_r", "rb_led_mon_s_r")]
    first = counts()
    again = jobs.training_job(spark, cfg, moment="m2", run_id="one", on_error="raise", **PARAMS)
    assert counts() == first and again.anomalies.result.count() == 240 and again.segments.model is not None
    jobs.training_job(spark, cfg, moment="m3", run_id="two", on_error="raise", **PARAMS)
    assert counts() == [2 * n for n in first]
    assert {r.id_momento for r in spark.table("rb_led_mon_s_r").collect()} == {"m1", "m3"}
    with pytest.raises(ValueError, match="ledger_table"):
        jobs.training_job(spark, config(scratch_dir, "r", ledger_table=None), run_id="x")


def test_a_run_cut_off_resumes_at_its_step(spark, scratch_dir, monkeypatch):
    rows_of(spark, "c")
    cfg = config(scratch_dir, "c")
    plain, calls = jobs._enrich_step, []
    monkeypatch.setattr(jobs, "_enrich_step", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        jobs.training_job(spark, cfg, moment="m", run_id="one", on_error="raise", **PARAMS)
    monkeypatch.setattr(jobs, "_enrich_step", plain)
    trained = jobs.train_anomaly_model
    monkeypatch.setattr(jobs, "train_anomaly_model", lambda *a, **k: calls.append(1) or trained(*a, **k))
    # cut off after the rows were appended, before the step was marked as done
    ledger = RunLedger(spark, cfg.ledger_table)
    assert ledger.is_done("one", "anomalies") and not ledger.is_done("one", "enriched")
    report = jobs.training_job(spark, cfg, moment="later", run_id="one", on_error="raise", **PARAMS)
    assert not calls and report.segments.error is None and ledger.is_done("one", "segments")
    monkeypatch.setattr(RunLedger, "is_done", lambda *a: False)
    before = spark.table("rb_led_mon_s_c").count()
    jobs.training_job(spark, cfg, moment="later", run_id="one", on_error="raise", **PARAMS)
    assert spark.table("rb_led_mon_s_c").count() == before and calls


def test_no_stale_table_is_enriched_after_a_recorded_failure(spark, scratch_dir):
    rows_of(spark, "f")
    cfg = config(scratch_dir, "f", ledger_table=None)
    jobs.training_job(spark, cfg, moment="m1", on_error="raise", **PARAMS)
    broken = config(scratch_dir, "f", anomaly_query="SELECT * FROM no_such_table", ledger_table=None)
    report = jobs.training_job(spark, broken, moment="m2", **PARAMS)
    assert report.anomalies.error is not None and report.enriched is None and isinstance(report.segments.error, jobs.StepSkipped)
    failures = spark.table("rb_led_mon_s_f").where("id_momento = 'm2'").collect()
    assert [(r.ejecucion, r.valor_indicador) for r in failures] == [(0, None)]
    on = jobs.training_job(spark, broken, moment="m3", after_failure="continue", **PARAMS)
    assert on.enriched is not None and on.segments.error is None
    with pytest.raises(Exception, match="no_such_table"):
        jobs.prediction_job(spark, broken, on_error="raise")


def test_append_once_treats_nulls_as_equal(spark):
    rows = spark.createDataFrame([(1, None, 1.0), (2, "b", 2.0)], "k int, s string, v double")
    assert append_once(rows, "rb_led_once", ["k", "s"]) == 2
    assert append_once(rows.withColumn("v", F.lit(9.0)), "rb_led_once", ["k", "s"]) == 0
    assert append_once(spark.createDataFrame([(1, "x", 1.0)], "k int, s string, v double"), "rb_led_once", ["k", "s"]) == 1
    assert spark.table("rb_led_once").count() == 3
