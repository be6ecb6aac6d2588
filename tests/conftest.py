import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from matchstats import tune  # noqa: E402


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("matchstats-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@pytest.fixture(scope="session")
def spark():
    return session()
