import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    warehouse = tmp_path_factory.mktemp("warehouse")
    s = (SparkSession.builder.master("local[*]")
         .appName("relayout-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.warehouse.dir", str(warehouse))
         .config("spark.checkpoint.dir", "file:" + str(tmp_path_factory.mktemp("scratch")))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from relayout.session import scratch_path

    return lambda name: scratch_path(spark, name)


SMOKE = "/root/testdata/sf0.001"
ORACLE = "/root/testdata/sf0.01"
