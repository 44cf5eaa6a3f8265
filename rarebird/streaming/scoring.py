"""Streaming scoring: the predict jobs (E2 anomalies, E5 segments) over micro-batches.

A fitted pipeline's transform is a narrow projection, so it applies to a streaming frame
as is; the flag is a column expression. Rows go through Spark's file sink, which is exactly-once
under replays; shares are aggregated from what is stored, so they describe the whole run.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rarebird.operators import metrics as M
from rarebird.operators.anomaly import DEFAULT_THRESHOLD, FLAG, flag_anomalies, stored_result
from rarebird.operators.features import drop_incomplete


def score_stream(stream: DataFrame, pipeline: PipelineModel, id_col: str,
                 threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Stored-layout flags of a streaming (or batch) frame: ``id, prediction, probability, anomalies``."""
    return stored_result(flag_anomalies(pipeline.transform(drop_incomplete(stream)), id_col, threshold), id_col)


def start_scoring(stream: DataFrame, pipeline_path: str, id_col: str, out_path: str, checkpoint_location: str,
                  threshold: float = DEFAULT_THRESHOLD, trigger: dict | None = None) -> StreamingQuery:
    """Start the streaming anomaly predict job. ``trigger`` is passed to ``DataStreamWriter.trigger``
    (e.g. ``{"availableNow": True}``)."""
    flags = score_stream(stream, PipelineModel.load(pipeline_path), id_col, threshold)
    return _start(flags, out_path, checkpoint_location, trigger)


def segment_stream(stream: DataFrame, pipeline: PipelineModel, id_col: str) -> DataFrame:
    """Stored-layout segments of a streaming (or batch) frame: ``id string, prediction int``."""
    from rarebird.plans.jobs import segment_rows

    return segment_rows(pipeline.transform(drop_incomplete(stream)), id_col)


def start_segment_scoring(stream: DataFrame, pipeline: str | PipelineModel, id_col: str, out_path: str,
                          checkpoint_location: str, trigger: dict | None = None) -> StreamingQuery:
    """Start the streaming segment predict job (a saved pipeline path or a fitted pipeline)."""
    model = PipelineModel.load(pipeline) if isinstance(pipeline, str) else pipeline
    return _start(segment_stream(stream, model, id_col), out_path, checkpoint_location, trigger)


def _start(rows: DataFrame, out_path: str, checkpoint_location: str, trigger: dict | None) -> StreamingQuery:
    """Spark's own file sink: it records which files each batch committed, so a batch that is
    delivered again replaces nothing and adds nothing."""
    writer = rows.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint_location)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def stream_shares(spark, out_path: str, moment: str, project: str = M.PROJECT) -> DataFrame:
    """Share rows of everything a stream has stored so far (flags or segments, by its columns)."""
    stored = spark.read.parquet(out_path)
    if FLAG in stored.columns:
        return M.anomaly_metric_rows(M.class_share(stored.select(FLAG), FLAG), moment, "predict", project)
    return M.segment_metric_rows(M.class_share(stored.select("prediction"), "prediction"), moment, "predict", project)


def file_stream(spark, fmt: str, path: str, schema) -> DataFrame:
    """A file stream over the files of a folder, or over one file of it (by Spark's glob filter)."""
    head, _, tail = path.rstrip("/").rpartition("/")
    reader = spark.readStream.format(fmt).schema(schema)
    if "." in tail and not any(ch in tail for ch in "*?[{"):
        status = _is_file(spark, path)
        if status:
            return reader.option("pathGlobFilter", tail).load(head)
    return reader.load(path)


def _is_file(spark, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).isFile(where))
