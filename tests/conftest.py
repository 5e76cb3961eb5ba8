from __future__ import annotations

import sys
from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from siltstone.context import RunContext  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("siltstone-tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def ctx():
    return RunContext("2024-01-01", datetime(2024, 1, 1, tzinfo=timezone.utc), date(2024, 1, 1), store="store")


@pytest.fixture
def no_stage():
    return lambda df, name: df
