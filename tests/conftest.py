import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    place = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("opinarium-tests")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(place / "warehouse"))
        .config("spark.checkpoint.dir", str(place / "shared"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def column(spark):
    """Apply a column function to a list of values."""
    from pyspark.sql import functions as F

    def apply(function, values, kind="string"):
        rows = [(i, value) for i, value in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, x {kind}")
        return [r[1] for r in df.select("i", function(F.col("x"))).orderBy("i").collect()]

    return apply
