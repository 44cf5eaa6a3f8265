import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rarebird.operators.features import (
    SCALE_CENTRED,
    SCALE_ONLY,
    drop_incomplete,
    feature_width,
    parse_columns,
    prepare,
    preparation_pipeline,
    split_roles,
)


def test_parse_columns():
    assert parse_columns("a,b") == ["a", "b"]
    assert parse_columns("") == []
    assert parse_columns([""]) == []
    assert parse_columns(None) == []


def test_drop_incomplete_null_and_nan(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.0)], "id int, x double")
    assert [r.id for r in drop_incomplete(df).collect()] == [3]


def test_drop_incomplete_id_counts(spark):
    df = spark.createDataFrame([(None, 1.0), (2, 2.0)], "id int, x double")
    assert drop_incomplete(df).count() == 1


def test_split_roles_keeps_frame_order():
    numeric, cats = split_roles(["id", "b", "c", "a", "d"], "c", "id")
    assert numeric == ["b", "a", "d"]
    assert cats == ["c"]


def test_unseen_category_is_zeros(spark):
    fit = spark.createDataFrame([(1, "b", 1.0), (2, "b", 1.0), (3, "a", 1.0), (4, "a", 1.0), (5, "c", 1.0)],
                                "id int, c string, x double")
    score = spark.createDataFrame([(6, "a", 1.0), (7, "b", 1.0), (8, "c", 1.0), (9, "zzz", 1.0)],
                                  "id int, c string, x double")
    model = preparation_pipeline(fit.columns, ["c"], "id", scale=None).fit(fit)
    rows = {r.id: r.v for r in model.transform(score).select("id", vector_to_array("features").alias("v")).collect()}
    # order: frequency desc then value asc -> a, b, c ; x comes first, then 3 slots
    assert rows[6] == [1.0, 1.0, 0.0, 0.0]
    assert rows[7] == [1.0, 0.0, 1.0, 0.0]
    assert rows[8] == [1.0, 0.0, 0.0, 1.0]
    assert rows[9] == [1.0, 0.0, 0.0, 0.0]
    assert feature_width(model, score) == 4


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 3.0, 5.0)], "id int, x double, y double")
    out = prepare(df, None, "id", scale=SCALE_CENTRED).frame
    rows = sorted((r.id, r.v) for r in out.select("id", vector_to_array("features").alias("v")).collect())
    assert rows == [(1, [-1.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 0.0])]


def test_scale_only_keeps_mean(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0)], "id int, x double")
    out = prepare(df, None, "id", scale=SCALE_ONLY).frame
    vals = sorted(r.v[0] for r in out.select(vector_to_array("features").alias("v")).collect())
    sd = math.sqrt(2.0)
    assert vals == pytest.approx([1 / sd, 3 / sd])


def test_pca_wider_than_data_raises(spark):
    from pyspark.errors import IllegalArgumentException

    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 2.0, 1.0), (3, 0.0, 3.0)], "id int, a double, b double")
    with pytest.raises(IllegalArgumentException):
        prepare(df, None, "id", scale=SCALE_CENTRED, pca_k=6)


def test_no_categorical_and_id_excluded(spark):
    df = spark.createDataFrame([(10, 1.0, 2.0)], "id int, a double, b double")
    out = prepare(df, "", "id", scale=None).frame
    assert out.columns == ["id", "features"]
    assert out.select(vector_to_array("features").alias("v")).first().v == [1.0, 2.0]


def test_preparation_is_narrow(spark):
    """Scoring with a fitted preparation has no shuffle."""
    df = spark.createDataFrame([(i, float(i), "a" if i % 2 else "b") for i in range(20)], "id int, x double, c string")
    model = preparation_pipeline(df.columns, ["c"], "id", scale=SCALE_CENTRED, pca_k=2).fit(df)
    plan = model.transform(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_drop_incomplete_equals_na_drop_and_pushes_not_null(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_totalprice")).alias("p"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(float("nan"))).otherwise(F.lit(1.0)).alias("q"),
        "o_orderpriority")
    assert sorted(drop_incomplete(df).collect()) == sorted(df.na.drop().collect())
    raw = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_totalprice")
    plan = drop_incomplete(raw)._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(o_totalprice)" in plan


def test_width_is_exact_and_guarded_everywhere(spark):
    from rarebird.operators import features as FT

    df = spark.range(3000).selectExpr("id", "cast(id AS string) AS code", "if(id < 5, null, cast(id % 3 AS string)) AS small")
    assert FT.category_counts(df, ["code", "small"]) == {"code": 3000, "small": 3}
    wide = FT.preparation_stages(df.columns, ["code", "small"], "id", scale=None)
    assert FT.check_width(df, wide) == 3003
    with pytest.raises(ValueError, match="3003"):
        FT.check_width(df, wide, max_width=3002)
    full = df.na.drop()
    for call in (lambda: FT.prepare(full, ["code"], "id", max_width=100),
                 lambda: FT.inference_features(full, ["code"], "id", max_width=100),
                 lambda: FT.prepare_supervised(full, ["code"], "small", feature_columns=["code"], max_width=100)):
        with pytest.raises(ValueError):
            call()


def test_id_cannot_be_categorical():
    from rarebird.operators.features import preparation_stages

    with pytest.raises(ValueError):
        preparation_stages(["id", "x"], ["id"], "id")


def test_supervised_split_takes_x_beside_X_and_is_released(spark):
    from rarebird.operators.features import prepare_supervised

    df = spark.range(100).selectExpr("id", "cast(id AS double) AS x", "cast(id % 3 AS string) AS c", "id % 2 AS y")
    split = prepare_supervised(df, ["c"], "y", key="id")
    train, test = split
    assert train.columns == ["id", "X", "y"] and train.count() + test.count() == 100
    assert split.encoded.is_cached and train.first().X.size == 4
    split.release()
    assert not split.encoded.is_cached and split.encoded.storageLevel.useMemory is False
    with pytest.raises(ValueError, match="another name"):
        prepare_supervised(df, ["c"], "y", key="id", output="Y")


def test_labels_are_counted_once_for_width_and_indexer(spark):
    """F1, F2 and F3 of round 4: the indexer comes fitted from the counts of the width check, as Spark's own would be."""
    from pyspark.ml.feature import StringIndexer, StringIndexerModel

    from rarebird.operators import features as FT

    values = ["b", "a", "\U0001f600", "\uff5e", "a", "b", "c", None, ""]
    df = spark.createDataFrame([(i, v, i % 3, float(i)) for i, v in enumerate(values)], "id int, s string, n int, x double")
    stages = FT.preparation_stages(df.columns, ["s", "n"], "id")
    fitted = FT.fitting_stages(df, stages)
    assert isinstance(stages[0], StringIndexer) and isinstance(fitted[0], StringIndexerModel)
    own = stages[0].fit(df)
    assert [list(x) for x in fitted[0].labelsArray] == [list(x) for x in own.labelsArray]
    rows = lambda m: [tuple(r) for r in m.transform(df).orderBy("id").collect()]
    assert fitted[0].getHandleInvalid() == "keep" and rows(fitted[0]) == rows(own)
    assert FT.category_counts(df, ["s", "n"]) == {"s": 6, "n": 3}
    empty = FT.fitting_stages(df.limit(0), stages)
    assert isinstance(empty[0], StringIndexer)
