import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def column(spark):
    """Values of a column function over plain strings."""
    from pyspark.sql import functions as F

    def apply(function, values, kind="string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, v {kind}")
        return [r["out"] for r in rows.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]

    return apply
