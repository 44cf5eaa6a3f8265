import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="rarebird-tests-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[*]")
        .appName("rarebird-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    # tests set their own checkpoint folder only where the session has none
    if not session.sparkContext.getCheckpointDir() and not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    yield session
    session.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="rarebird-case-", dir="/tmp")
