from __future__ import annotations

import os
import sys
import tempfile
import uuid

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    base = tempfile.mkdtemp(prefix="reconlake-tests-")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("reconlake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", f"{base}/scratch")
        .config("spark.sql.warehouse.dir", f"{base}/warehouse")
        .config("spark.driver.extraJavaOptions", "-Dderby.stream.error.file=/dev/null")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def schema(spark):
    """A new schema of its own for each test."""
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {name}")
    return name


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
