import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from martloom.session import get_spark, scratch_dir  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "tests", "local[8]", spark_ui_enabled="false", spark_sql_shuffle_partitions="8", spark_driver_memory="8g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return SF


@pytest.fixture
def fresh(spark, request):
    """A new folder name for each test."""
    return scratch_dir(spark, "test")


@pytest.fixture
def plan_of():
    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
