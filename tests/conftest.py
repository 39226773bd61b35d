import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
for p in (str(ROOT), str(ROOT / "tests")):
    if p not in sys.path:
        sys.path.insert(0, p)

from pulsepanel.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture()
def panel(spark):
    """Panel from {region: [(date text, value...)]} rows with named value columns."""
    from pyspark.sql import functions as F

    def build(rows, columns):
        schema = "region string, date string, " + ", ".join(f"{c} double" for c in columns)
        df = spark.createDataFrame(rows, schema)
        return df.withColumn("date", F.col("date").cast("date"))

    return build
