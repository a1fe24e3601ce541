from __future__ import annotations

import os

import pytest
from pyspark.sql import SparkSession

from peernet import RunConfig
from peernet.config import clear_shared_dir, configure


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield configure(session)
    clear_shared_dir(session)


@pytest.fixture(scope="session")
def cfg():
    return RunConfig(
        run_started_at="2024-01-31 00:00:00", as_of="2024-01-31 00:00:00", initial_bound="2024-01-01 00:00:00"
    )


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
