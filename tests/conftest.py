import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def make_spark():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]").appName("boostframe-tests")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():   # tests only: the cluster names its own
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bf-ck-"))
    return spark


@pytest.fixture(scope="session")
def spark():
    return make_spark()


SF = os.environ.get("BF_TEST_SF", "/root/testdata/sf0.001")
