from __future__ import annotations

import datetime as dt
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tillroll.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tillroll-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tillroll-tests-"))
        .config("spark.sql.maxMetadataStringLength", "2000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture()
def day():
    return dt.date(2024, 6, 30)


def rows(df, *order):
    """Rows as tuples, in a fixed order."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is None, v) for v in r)) if not order else found
