from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
# Python workers (mapInPandas in the push sink) import the package and the
# test transports; they inherit PYTHONPATH from the JVM started below.
os.environ["PYTHONPATH"] = os.pathsep.join(
    p for p in [str(ROOT), os.environ.get("PYTHONPATH", "")] if p)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[4]")
             .appName("turnstile-tests")
             .config("spark.sql.shuffle.partitions", "4")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "4g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="turnstile-test-ckpt-"))
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def src(spark):
    from tests.fixtures import ticketing_sources
    return ticketing_sources(spark)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="turnstile-test-")
