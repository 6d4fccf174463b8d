from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from vigilmart import settings  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("vigilmart-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.default.parallelism", "2")
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.checkpoint.dir", f"file://{work}/shared")
        .config("spark.sql.warehouse.dir", f"file://{work}/warehouse")
    )
    session = settings.tuned(builder, shuffle_partitions=2).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)
