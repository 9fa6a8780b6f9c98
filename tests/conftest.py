import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from vecflow.deploy import ship_package  # noqa: E402


def make_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("vecflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def spark():
    return make_session()


@pytest.fixture(scope="session")
def folder() -> str:
    return "/root/testdata/sf0.001"
