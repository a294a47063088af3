"""What test modules and ``compare.py`` import: the tables' folder and a session. Not in conftest.py, of which there may be several."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("daygrid-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="daygrid-tests-"))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
