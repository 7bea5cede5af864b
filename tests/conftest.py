import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from trailmark.session import with_settings  # noqa: E402


def make_session() -> SparkSession:
    builder = SparkSession.builder.master("local[8]").appName("trailmark-tests")
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="trailmark-shared-"),
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="trailmark-warehouse-"),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = with_settings(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()
