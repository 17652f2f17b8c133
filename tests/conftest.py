import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("SIFTMILL_DATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    conf = {
        "spark.master": "local[8]", "spark.driver.memory": "4g", "spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": f"file://{tempfile.mkdtemp(prefix='spark-')}",
    }
    session = SparkSession.builder.config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{DATA}/sf0.001"
