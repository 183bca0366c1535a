import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shared-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """Make a frame of raw lines, each from a log text (or a raw line as is)."""
    import json

    def make(*logs, time="2025-06-16T10:00:00Z", raw=(), **columns):
        rows = [json.dumps({"log": log, "time": time, "stream": "stdout"}) for log in logs]
        rows += list(raw)
        return spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "id int, value string")

    return make


@pytest.fixture
def mapping(spark):
    def make(*rows):
        full = [(i, *row) for i, row in enumerate(rows)]
        return spark.createDataFrame(
            full,
            "ord int, akun_nasional string, domain string, nama_instansi string, tipe_instansi string",
        )

    return make
