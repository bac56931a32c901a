import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tablesnap-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.log.level", "OFF")
        .getOrCreate()
    )
    yield session
    session.stop()


@pytest.fixture
def new_store(spark, tmp_path):
    from tablesnap import Store

    def make(name="store", **options):
        options = {"base_url": "https://lab.example.com/ctx", "container_path": "/Home", **options}
        return Store(spark, str(tmp_path / name), **options)

    return make
