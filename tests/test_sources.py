import os

import pytest
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.linalg import Vectors

from rarebird.operators.clustering import mixture
from rarebird.sources import models as S_models
from rarebird.sources import tables as S_tables


def test_load_three_models_without_fitting(spark, scratch_dir):
    df = spark.createDataFrame([(Vectors.dense([float(i % 7), float(i % 5), float(i % 3)]),) for i in range(60)],
                               ["raw"])
    scaler = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True).fit(df)
    scaled = scaler.transform(df)
    pca = PCA(k=2, inputCol="scaled", outputCol="features").fit(scaled)
    gmm = mixture(2, max_iter=5).fit(pca.transform(scaled))
    paths = [os.path.join(scratch_dir, n) for n in ("gmm", "scaler", "pca")]
    for model, path in zip((gmm, scaler, pca), paths):
        S_models.save_model(model, path)
    model, sc, pc = S_models.load_models(*paths, family="mixture")
    assert model.getK() == 2 and sc.getWithMean() and pc.getK() == 2
    a = sorted(v for r in gmm.transform(pca.transform(scaled)).collect() for v in r.probability)
    b = sorted(v for r in model.transform(pc.transform(sc.transform(df))).collect() for v in r.probability)
    assert a == pytest.approx(b)


def test_csv_source_with_schema_and_header(spark, scratch_dir):
    path = os.path.join(scratch_dir, "csv")
    spark.createDataFrame([(1, "a", 1.5), (2, "b", 2.5)], "id int, s string, x double").write.option(
        "header", "true").csv(path)
    df = S_tables.read_file(spark, "csv", path, "id INT, s STRING, x DOUBLE", header=True)
    assert sorted(tuple(r) for r in df.collect()) == [(1, "a", 1.5), (2, "b", 2.5)]
    assert dict(df.dtypes) == {"id": "int", "s": "string", "x": "double"}


def test_ctas_replaces_and_append_matches_by_name(spark, scratch_dir):
    first = spark.createDataFrame([(1, "a")], "id int, s string")
    S_tables.replace_table_ctas(spark, first, "rb_src_ctas")
    S_tables.replace_table_ctas(spark, first.union(first), "rb_src_ctas")  # dropped and rebuilt
    assert spark.table("rb_src_ctas").count() == 2
    S_tables.append_table(spark.createDataFrame([("b", 2)], "s string, id int"), "rb_src_ctas")
    assert sorted(tuple(r) for r in spark.table("rb_src_ctas").collect()) == [(1, "a"), (1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        S_tables.append_table(spark.createDataFrame([(3,)], "id int"), "rb_src_ctas")
    with pytest.raises(ValueError):  # a further column would be lost
        S_tables.append_table(spark.createDataFrame([(3, "c", 1)], "id int, s string, x int"), "rb_src_ctas")
    S_tables.replace_table_ctas(spark, spark.table("rb_src_ctas").where("id = 1"), "rb_src_ctas")  # reads itself
    assert spark.table("rb_src_ctas").count() == 2


def test_ctas_with_a_path_twice_and_a_failing_write(spark, scratch_dir):
    from pyspark.sql import functions as F

    for n in (3, 5):
        S_tables.replace_table_ctas(spark, spark.range(n), "rb_src_ctas_path", path=scratch_dir + "/t")
        assert spark.table("rb_src_ctas_path").count() == n
    bad = spark.range(3).withColumn("x", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        S_tables.replace_table_ctas(spark, bad, "rb_src_ctas_path", path=scratch_dir + "/t")
    assert spark.table("rb_src_ctas_path").count() == 5


def test_table_location():
    assert S_tables.table_location("s3://b/root/", "db.t") == "s3://b/root/db/t"
    assert S_tables.table_location(None, "t") is None


def test_sql_source_passes_frames(spark):
    df = spark.range(3)
    assert S_tables.sql_source(spark, df) is df


def _files(spark, path):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [x.getPath().getName() for x in fs.listStatus(where)] if fs.exists(where) else []


@pytest.mark.parametrize("place", [None, "folder"])
def test_overwrite_swaps_and_a_dying_write_leaves_the_old_table(spark, scratch_dir, place):
    from pyspark.sql import functions as F

    name, path = f"rb_swap_{place or 'managed'}", f"{scratch_dir}/t" if place else None
    for n in (3, 5):
        S_tables.overwrite_table(spark.range(n), name, path=path)
        assert spark.table(name).count() == n
    bad = spark.range(3).withColumn("id", F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        S_tables.overwrite_table(bad, name, path=path)
    assert spark.table(name).count() == 5
    S_tables.overwrite_table(spark.table(name).where("id > 0"), name, path=path)  # reads itself
    assert spark.table(name).count() == 4
    S_tables.append_table(spark.range(1), name)
    S_tables.overwrite_table(spark.createDataFrame([(1, "a")], "k int, s string"), name, path=path)  # other columns
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, "a")]
    if path:
        assert len(_files(spark, path)) == 1  # older versions are gone
    spark.sql(f"DROP TABLE {name}")


def test_a_table_written_straight_into_its_folder_is_swapped_too(spark, scratch_dir):
    spark.range(4).write.option("path", f"{scratch_dir}/old").saveAsTable("rb_swap_flat")
    S_tables.overwrite_table(spark.range(6), "rb_swap_flat", path=f"{scratch_dir}/old")
    assert spark.table("rb_swap_flat").count() == 6 and len(_files(spark, f"{scratch_dir}/old")) == 1


@pytest.mark.parametrize("at", [1, 2])
def test_a_crash_between_the_renames_leaves_one_of_the_two(spark, monkeypatch, at):
    name = f"rb_crash_{at}"
    S_tables.overwrite_table(spark.range(3), name)
    plain, calls = S_tables._rename, []

    def dies(spark_, a, b):
        calls.append(a)
        if len(calls) == at:
            raise KeyboardInterrupt
        plain(spark_, a, b)

    monkeypatch.setattr(S_tables, "_rename", dies)
    with pytest.raises(KeyboardInterrupt):
        S_tables.overwrite_table(spark.createDataFrame([("x",)], "s string"), name)
    monkeypatch.undo()
    assert S_tables.recover_table(spark, name) == (at == 2)
    assert spark.table(name).columns == (["id"] if at == 1 else ["s"])
    S_tables.overwrite_table(spark.range(7), name)
    assert spark.table(name).count() == 7 and not S_tables.recover_table(spark, name)
