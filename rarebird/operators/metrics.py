"""Class shares and monitoring rows.

Shares are one grouped pass (partial aggregation on the map side, so a class holding most
rows costs no more than any other); the grand total and the rank labels are windows over the
handful of grouped rows only (one row per class), never over the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Monitoring table layout and labels the stored rows must carry.
MONITORING_COLUMNS = (
    "valor_indicador",
    "id_momento",
    "proyecto",
    "modelo",
    "ejecucion",
    "id_indicador",
    "nombre_indicador",
)
PROJECT = "FRICCIONES"
ANOMALY_MODEL_TRAIN = "anomalias_fricciones_ent"
ANOMALY_MODEL_PREDICT = "anomalias_fricciones_pre"
SEGMENT_MODEL_TRAIN = "segmentacion_anomalias_fricciones_ent"
SEGMENT_MODEL_PREDICT = "segmentacion_anomalias_fricciones_pre"
MODEL_SUMMARY = "anomalias_fricciones"
CLASS_LABEL_PREFIX = "anomalias_gf_"
SILHOUETTE_NAME = "silhouette_score"
CLUSTER_COUNT_NAME = "numero_clusters"
SHARE_INDICATOR = 2
SUMMARY_INDICATOR = 1
RUN_OK = 1
RUN_FAILED = 0
ANOMALY_FAILURE_LABEL = "anomalias_gf_1"
SEGMENT_FAILURE_LABEL = "anomalias_gf_0"

MONITORING_SCHEMA = T.StructType(
    [
        T.StructField("valor_indicador", T.FloatType(), True),
        T.StructField("id_momento", T.StringType(), False),
        T.StructField("proyecto", T.StringType(), False),
        T.StructField("modelo", T.StringType(), False),
        T.StructField("ejecucion", T.IntegerType(), False),
        T.StructField("id_indicador", T.IntegerType(), False),
        T.StructField("nombre_indicador", T.StringType(), False),
    ]
)

SHARE = "valor_indicador"
COUNT = "row_count"


def class_share(df: DataFrame, class_col: str, weight: str | None = None) -> DataFrame:
    """G1 + G2 + G4: ``class_col, row_count, valor_indicador`` (percent of all rows),
    largest share first, ties by class. ``weight`` names a column of whole numbers to count rows by."""
    number = F.sum(F.col(weight).cast("long")) if weight else F.count(F.lit(1))
    counts = df.groupBy(class_col).agg(number.alias(COUNT))
    total = F.sum(COUNT).over(Window.partitionBy())  # over the grouped rows (one per class)
    return counts.select(
        class_col, COUNT, (F.col(COUNT) / total * F.lit(100)).alias(SHARE)
    ).orderBy(F.col(SHARE).desc(), F.col(class_col))


def _model_name(family: str, stage: str) -> str:
    names = {
        ("anomaly", "train"): ANOMALY_MODEL_TRAIN,
        ("anomaly", "predict"): ANOMALY_MODEL_PREDICT,
        ("segment", "train"): SEGMENT_MODEL_TRAIN,
        ("segment", "predict"): SEGMENT_MODEL_PREDICT,
    }
    try:
        return names[(family, stage)]
    except KeyError:
        raise ValueError(f"unknown family/stage {family!r}/{stage!r}") from None


def _rows(value: Column, moment: str, project: str, model: str, run: int, indicator: int, name: Column) -> list:
    return [
        value.cast("float").alias("valor_indicador"),
        F.lit(moment).alias("id_momento"),
        F.lit(project).alias("proyecto"),
        F.lit(model).alias("modelo"),
        F.lit(run).cast("int").alias("ejecucion"),
        F.lit(indicator).cast("int").alias("id_indicador"),
        name.alias("nombre_indicador"),
    ]


def anomaly_metric_rows(
    shares: DataFrame, moment: str, stage: str = "train", project: str = PROJECT, flag_col: str = "anomalies"
) -> DataFrame:
    """One monitoring row per flag value, named ``anomalias_gf_<flag>``."""
    name = F.concat(F.lit(CLASS_LABEL_PREFIX), F.col(flag_col).cast("string"))
    return shares.select(
        *_rows(F.col(SHARE), moment, project, _model_name("anomaly", stage), RUN_OK, SHARE_INDICATOR, name)
    )


def rank_labels(shares: DataFrame, class_col: str = "prediction") -> DataFrame:
    """Rank 0..n-1 by ascending share, ties by class id (a window over the few class rows)."""
    w = Window.orderBy(F.col(SHARE).asc(), F.col(class_col).asc())
    return shares.withColumn("share_rank", (F.row_number().over(w) - 1).cast("int"))


def segment_metric_rows(
    shares: DataFrame, moment: str, stage: str = "train", project: str = PROJECT, class_col: str = "prediction"
) -> DataFrame:
    """One monitoring row per segment, named by its rank of ascending share."""
    ranked = rank_labels(shares, class_col)
    name = F.concat(F.lit(CLASS_LABEL_PREFIX), F.col("share_rank").cast("string"))
    return ranked.select(
        *_rows(F.col(SHARE), moment, project, _model_name("segment", stage), RUN_OK, SHARE_INDICATOR, name)
    )


def model_metric_rows(
    spark: SparkSession, silhouette: float | None, k: int | None, moment: str, project: str = PROJECT
) -> DataFrame:
    """T3 + T4: the silhouette and the cluster count of a fitted model (two rows)."""
    rows = [
        (None if silhouette is None else float(silhouette), moment, project, MODEL_SUMMARY, RUN_OK,
         SUMMARY_INDICATOR, SILHOUETTE_NAME),
        (None if k is None else float(k), moment, project, MODEL_SUMMARY, RUN_OK, SUMMARY_INDICATOR,
         CLUSTER_COUNT_NAME),
    ]
    return spark.createDataFrame(rows, MONITORING_SCHEMA)


def failure_row(spark: SparkSession, family: str, stage: str, moment: str, project: str = PROJECT) -> DataFrame:
    """T5 (anomaly) / T6 (segment): the row a failed run leaves in the monitoring table."""
    label = ANOMALY_FAILURE_LABEL if family == "anomaly" else SEGMENT_FAILURE_LABEL
    row = (None, moment, project, _model_name(family, stage), RUN_FAILED, SHARE_INDICATOR, label)
    return spark.createDataFrame([row], MONITORING_SCHEMA)


def monitoring_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack monitoring frames by column name in the fixed column order."""
    out = None
    for f in frames:
        f = f.select(*MONITORING_COLUMNS)
        out = f if out is None else out.unionByName(f)
    if out is None:
        raise ValueError("no monitoring frames")
    return out
