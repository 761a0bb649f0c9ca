import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    base = tempfile.mkdtemp(prefix="orrery-test-")
    session = (
        SparkSession.builder.master("local[8]").appName("orrery-tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{base}/checkpoints").config("spark.sql.warehouse.dir", f"{base}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return os.environ.get("ORRERY_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def tables():
    return (
        "region nation customer supplier part orders lineitem events documents embeddings pages "
        "benchmark labels conversations"
    ).split()
