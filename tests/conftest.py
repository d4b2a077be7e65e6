import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        # Tests only: no shared folder configured, so use a fresh local one.
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakeloom-test-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_out(spark):
    from lakeloom.session import scratch_path
    return lambda name: scratch_path(spark, name)
