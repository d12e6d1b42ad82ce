import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tremor.conf import SESSION_CONF  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[4]").appName("tests")
    local = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="warehouse-"),
    }
    for key, value in {**SESSION_CONF, **local}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def in_zone(spark):
    """Set the session's time zone for one test."""
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda zone: spark.conf.set("spark.sql.session.timeZone", zone)
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
