import pytest

from rarebird.session import _shared_root, checkpoint_dir, shared_path


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.sparkContext.getCheckpointDir()
    assert configured  # set by spark.checkpoint.dir (or by the test fixture when none was configured)
    assert checkpoint_dir(spark) == configured


def test_outputs_do_not_live_among_checkpoints(spark):
    a, b = (shared_path(spark, "models", "m", unique=True) for _ in range(2))
    assert "/rarebird/models/m-" in a and a != b
    assert not a.startswith(checkpoint_dir(spark))
    assert shared_path(spark, "tables", "t").endswith("/rarebird/tables/t")


def test_no_machine_local_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()
        conf = {"spark.sql.warehouse.dir": "file:/tmp/warehouse"}

    with pytest.raises(ValueError):
        _shared_root(Session())
    Session.conf = {"spark.sql.warehouse.dir": "hdfs://nn/warehouse/"}
    assert _shared_root(Session()) == "hdfs://nn/warehouse"
