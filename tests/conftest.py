from __future__ import annotations

import os

import pytest
from pyspark.sql import SparkSession


def make_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[*]")
        .appName("msgloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", "/tmp/msgloom-warehouse")
        .config("spark.driver.memory", os.environ.get("TEST_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    return make_session()
