import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(work / "warehouse"))
        .config("spark.checkpoint.dir", str(work / "scratch"))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as sorted tuples, NULL before any value."""

    def collect(df):
        return sorted(
            (tuple(r) for r in df.collect()),
            key=lambda r: tuple((v is not None, str(v)) for v in r),
        )

    return collect


@pytest.fixture
def layout(spark, tmp_path):
    import uuid

    from stratalake.config import Layout

    made = Layout(str(tmp_path / "lake"), f"t{uuid.uuid4().hex[:10]}")
    made.create_databases(spark)
    return made
