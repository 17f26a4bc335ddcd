import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("strataudit-tests")
               .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "6g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return os.path.join(DATA, "sf0.001")


@pytest.fixture(scope="session")
def sf_mid():
    return os.path.join(DATA, "sf0.01")
