from rarebird.operators.enrich import dedupe, enrich, enrich_and_dedupe
from pyspark.sql import functions as F

from rarebird.operators.sampling import bootstrap_sample, keyed_split, random_split, with_split


def test_dedupe_order_desc_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, 5.0, "a"), (1, 9.0, "b"), (1, None, "c"), (2, None, "d"), (2, 1.0, "e"), (3, 2.0, "f"), (3, 2.0, "g")],
        "k int, v double, s string",
    )
    got = {r.k: r.s for r in dedupe(df, "k", order_by=["-v", "s"]).collect()}
    assert got == {1: "b", 2: "e", 3: "f"}
    asc = {r.k: r.s for r in dedupe(df, "k", order_by=["v", "s"]).collect()}
    assert asc == {1: "c", 2: "d", 3: "f"}


def test_dedupe_without_order_one_row_per_key(spark):
    df = spark.range(100).selectExpr("id % 7 AS k", "id")
    assert dedupe(df, "k").count() == 7


def test_dedupe_hot_key_is_limited_before_the_shuffle(spark):
    # a third of the rows on one key: each map partition sends one row of it
    df = spark.range(3000).selectExpr("CASE WHEN id < 1000 THEN 0 ELSE id END AS k", "id AS v")
    out = dedupe(df, "k", order_by=["-v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert out.filter("k = 0").first().v == 999


def test_dedupe_with_maps_and_descending_text(spark):
    df = spark.createDataFrame([(1, "a", {"x": 1}), (1, "c", {"y": 2}), (1, None, {}), (2, None, None)], "k int, s string, m map<string,int>")
    assert {r.k: (r.s, r.m) for r in dedupe(df, "k", order_by=["-s"]).collect()} == {1: ("c", {"y": 2}), 2: (None, None)}


def test_enrich_and_dedupe(spark):
    a = spark.createDataFrame([(1, 10), (1, 20), (2, 30)], "k int, x int")
    b = spark.createDataFrame([(1, "one"), (2, "two")], "k int, name string")
    out = dedupe(enrich(a, b, "k"), "k", order_by=["-x"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, 20, "one"), (2, 30, "two")]
    a.createOrReplaceTempView("rb_enrich_a")
    assert enrich_and_dedupe(spark, "SELECT * FROM rb_enrich_a", "k", ["x"]).count() == 2


def test_keyed_split_disjoint_complete_and_stable(spark):
    df = spark.range(2000).withColumnRenamed("id", "key")
    train, test = keyed_split(df, "key", 0.7)
    tr = {r.key for r in train.collect()}
    te = {r.key for r in test.collect()}
    assert not tr & te and len(tr | te) == 2000
    assert 0.6 < len(tr) / 2000 < 0.8
    again, _ = keyed_split(df.repartition(7), "key", 0.7)
    assert {r.key for r in again.collect()} == tr
    labelled = with_split(df, "key", 0.7)
    assert labelled.filter("split = 'train'").count() == len(tr)


def test_random_split_disjoint(spark):
    df = spark.range(500)
    a, b = random_split(df, 0.7, seed=1)
    ids_a, ids_b = {r.id for r in a.collect()}, {r.id for r in b.collect()}
    assert not ids_a & ids_b and len(ids_a | ids_b) == 500


def test_bootstrap_size_and_repeats(spark):
    df = spark.range(20000)
    s = bootstrap_sample(df, 0.5, seed=3)
    n = s.count()
    assert 9000 < n < 11000
    assert s.groupBy("id").count().filter("count > 1").count() > 0


def test_salted_enrich_equals_plain_join(spark):
    from rarebird.operators.enrich import hot_keys

    # a third of the rows on key 0
    left = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS v")
    right = spark.range(3000).selectExpr("id AS k", "concat('n', id) AS name").union(
        spark.createDataFrame([(0, "zero-bis")], "k long, name string"))
    assert 0 in hot_keys(left, "k", 0.1)
    for how in ["inner", "left", "left_anti", "left_semi"]:
        plain = sorted(tuple(r) for r in enrich(left, right, "k", how).collect())
        salted = sorted(tuple(r) for r in enrich(left, right, "k", how, skew_keys="auto", rows_per_bucket=100,
                                                 hot_share=0.1).collect())
        assert plain == salted, how
    per_bucket = (enrich(left, right, "k", skew_keys=[0], rows_per_bucket=100)
                  .filter("k = 0").count())
    assert per_bucket == 1000 * 2


def test_keyed_bootstrap_is_stable(spark):
    from rarebird.operators.sampling import keyed_bootstrap

    df = spark.range(20000).withColumnRenamed("id", "key")
    a = keyed_bootstrap(df, "key", 0.5, 3).collect()
    assert sorted(a) == sorted(keyed_bootstrap(df.repartition(7), "key", 0.5, 3).collect())
    assert 9500 < len(a) < 10500 and max(r.draw for r in a) >= 2


def test_salted_enrich_rejects_outer(spark):
    import pytest

    df = spark.range(3).withColumnRenamed("id", "k")
    with pytest.raises(ValueError):
        enrich(df, df, "k", "full", skew_keys=[0])


def test_equal_rows_spread_over_all_buckets(spark, scratch_dir):
    from rarebird.operators import enrich as E

    spark.range(40_000).select(F.lit(7).alias("k"), F.lit("same").alias("v")).repartition(3).write.parquet(f"{scratch_dir}/same")
    stored = spark.read.parquet(f"{scratch_dir}/same")
    made = spark.range(40_000).select(F.lit(7).alias("k"), F.lit("same").alias("v"))
    for df in (stored, stored.where("v = 'same'").select("v", "k"), made):
        buckets = E._buckets(df, "k", [7], 1000)
        sizes = [r["count"] for r in E._dealt(df, buckets, "b").groupBy("b").count().collect()]
        assert len(sizes) == 40 and max(sizes) < 2000 and sum(sizes) == 40_000
        again = E._dealt(df, buckets, "b").groupBy("b").count()
        assert sorted(r["count"] for r in again.collect()) == sorted(sizes)
    source = spark.createDataFrame([(7, "x"), (7, "y"), (8, "z")], "k int, w string")
    assert E.enrich(stored, source, "k", skew_keys="auto", rows_per_bucket=1000).count() == 80_000


def test_place_is_unique_where_a_scan_row_comes_out_twice(spark, scratch_dir):
    from rarebird.operators.enrich import row_place

    spark.range(50).write.parquet(f"{scratch_dir}/r")
    df = spark.read.parquet(f"{scratch_dir}/r")
    for frame in (df.union(df), df.withColumn("x", F.explode(F.array(F.lit(1), F.lit(2)))), df.join(df.withColumnRenamed("id", "j"), F.col("id") % 5 == F.col("j"))):
        placed = row_place(frame, "p")
        assert placed.select("p").distinct().count() == frame.count() == placed.count()


def test_both_sides_hot_meet_in_a_grid(spark, scratch_dir):
    from rarebird.operators.enrich import enrich

    left = spark.range(600).selectExpr("IF(id < 400, 1, id) AS k", "'l' AS a")
    right = spark.range(90).selectExpr("IF(id < 60, 1, id) AS k", "id AS b")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = left.join(right, "k", how)
        salted = enrich(left, right, "k", how, skew_keys=[1], rows_per_bucket=50)
        assert sorted(map(str, salted.collect())) == sorted(map(str, plain.select(*salted.columns).collect()))
    dealt = enrich(left, right, "k", "inner", skew_keys=[1], rows_per_bucket=50)
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan and "__other_salt" in plan
