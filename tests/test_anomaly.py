from pyspark.ml.linalg import Vectors

from rarebird.functions.columns import membership_flag
from rarebird.operators.anomaly import flag_anomalies, stored_result


def test_threshold_truth_table_arrays(spark):
    df = spark.createDataFrame(
        [(1, [0.7, 0.3]), (2, [0.69, 0.31]), (3, [float("nan"), 0.1]), (4, [])], "id int, p array<double>"
    )
    got = {r.id: r.f for r in df.select("id", membership_flag("p", 0.7, vector=False).alias("f")).collect()}
    assert got == {1: 0, 2: 1, 3: 0, 4: 1}


def test_threshold_matches_python_all(spark):
    cases = [[0.7, 0.3], [0.69, 0.31], [float("nan"), 0.1], [], [0.2, 0.2, 0.6], [0.9]]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "id int, p array<double>")
    got = {r.id: r.f for r in df.select("id", membership_flag("p", 0.7, vector=False).alias("f")).collect()}
    expected = {i: (1 if all(x < 0.7 for x in c) else 0) for i, c in enumerate(cases)}
    assert got == expected


def test_flags_on_vectors_and_stored_layout(spark):
    df = spark.createDataFrame(
        [(1, 0, Vectors.dense([0.25, 0.75])), (2, 1, Vectors.dense([0.5, 0.5])), (1, 0, Vectors.dense([0.25, 0.75]))],
        ["id", "prediction", "probability"],
    )
    flags = flag_anomalies(df, "id", 0.7)
    stored = stored_result(flags, "id")
    rows = sorted(tuple(r) for r in stored.collect())
    # repeated ids survive; memberships stored as text
    assert rows == [("1", 0, "[0.25,0.75]", 0), ("1", 0, "[0.25,0.75]", 0), ("2", 1, "[0.5,0.5]", 1)]
    assert [f.dataType.simpleString() for f in stored.schema.fields] == ["string", "int", "string", "int"]


def test_flag_plan_has_no_python_and_no_exchange(spark):
    df = spark.createDataFrame([(i, 0, Vectors.dense([0.5, 0.5])) for i in range(10)], ["id", "prediction", "probability"])
    plan = flag_anomalies(df, "id")._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "Exchange" not in plan and "Window" not in plan
