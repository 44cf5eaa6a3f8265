import os

from rarebird.plans import jobs
from rarebird.plans.registry import lineitem
from rarebird.streaming import start_scoring, stream_shares

SF = "/root/testdata/sf0.001"


def test_stream_scoring_equals_batch_predict(spark, scratch_dir):
    li = lineitem(spark, SF)
    path = os.path.join(scratch_dir, "pipe")
    jobs.train_anomaly_model(spark, li, ["l_returnflag", "l_linestatus"], "line_id", pipeline_path=path,
                             ks=[3], moment="m", max_iter=10)
    src = os.path.join(scratch_dir, "src")
    li.write.parquet(src)
    stream = spark.readStream.schema(li.schema).parquet(src)
    out, ckpt = os.path.join(scratch_dir, "out"), os.path.join(scratch_dir, "ckpt")
    for _ in range(2):  # the second start finds every batch committed
        q = start_scoring(stream, path, "line_id", out, ckpt, trigger={"availableNow": True})
        q.awaitTermination(300)
    rows = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    batch = jobs.predict_anomalies(spark, li, "line_id", pipeline_path=path, moment="m").result
    from rarebird.operators.anomaly import stored_result
    expected = sorted(tuple(r) for r in stored_result(batch, "line_id").collect())
    assert rows == expected
    mon = stream_shares(spark, out, "m").collect()
    assert abs(sum(r.valor_indicador for r in mon) - 100.0) < 1e-3


def test_file_stream_single_file_glob(spark):
    from rarebird.streaming import file_stream

    s = file_stream(spark, "parquet", f"{SF}/lineitem.parquet", spark.read.parquet(f"{SF}/lineitem.parquet").schema)
    assert s.isStreaming

    def all_rows(batch, _):
        seen.append(batch.count())

    seen = []
    s.writeStream.foreachBatch(all_rows).trigger(availableNow=True).start().awaitTermination()
    assert sum(seen) == spark.read.parquet(f"{SF}/lineitem.parquet").count()
