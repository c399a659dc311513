import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from airhour.session import create_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = create_session(
        "airhour-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def utc():
    """Timestamps as text ``yyyy-MM-dd HH:mm``, independent of the client's zone."""
    from pyspark.sql import functions as F

    def text(df, column="time"):
        return [r[0] for r in df.select(F.date_format(column, "yyyy-MM-dd HH:mm")).collect()]

    return text


READING = "time string, location string, status string, "


@pytest.fixture
def frame(spark):
    """A readings frame from rows whose time is ISO text."""
    from pyspark.sql import functions as F

    def make(rows, metrics="co_mean double"):
        return spark.createDataFrame(rows, READING + metrics).withColumn("time", F.col("time").cast("timestamp"))

    return make
