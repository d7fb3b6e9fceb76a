import pytest
from pyspark.sql import SparkSession

import tickloom


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tickloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tickloom.configure(session)
    session.stop()


@pytest.fixture(autouse=True)
def _settings(spark):
    before = {k: v for k, v in spark.conf.getAll.items()} if hasattr(spark.conf, "getAll") else {}
    yield
    for key, value in before.items():
        if spark.conf.isModifiable(key) and spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
