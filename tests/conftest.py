import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from settleflow.session import configure  # noqa: E402

SMALL = "/root/testdata/sf0.001"


# Started on import: tables of test inputs hold columns, which need a session.
SESSION = (
    SparkSession.builder.master("local[8]")
    .appName("settleflow-tests")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.driver.memory", "8g")
    .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="settleflow-tests-"))
    .getOrCreate()
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield configure(SESSION)
    SESSION.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def put(**options):
        for key, value in options.items():
            name = "spark.sql." + key.replace("_", ".")
            before.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.set(name, value)


def bag(df):
    """Rows as a sorted list, so that flows compare as bags."""
    return sorted((tuple(row) for row in df.collect()), key=repr)
