import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from marketlake.session import configure  # noqa: E402
from marketlake.sources.lake import Lake  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(work / "shared"))
        .config("spark.sql.warehouse.dir", str(work / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture
def sf_dir():
    return SF_DIR


@pytest.fixture
def landed(spark):
    """Landed answers from ``(request_key, status, body)`` tuples."""
    from datetime import datetime

    from marketlake.contracts import LANDED

    def make(source, *answers):
        rows = [(source, key, datetime(2025, 1, 17), status, body) for key, status, body in answers]
        return spark.createDataFrame(rows, LANDED)

    return make


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
