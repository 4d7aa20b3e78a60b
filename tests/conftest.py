import os
import tempfile

import pytest
from pyspark.sql import SparkSession

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("changeloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="changeloom-warehouse-"))
    )
    session = builder.getOrCreate()
    if not session.sparkContext.getConf().get("spark.checkpoint.dir", ""):
        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="changeloom-checkpoint-"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(TESTDATA):
        pytest.skip("no test data")
    return TESTDATA
