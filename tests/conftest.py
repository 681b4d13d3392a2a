import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tidegauge.session import local_session

    return local_session(8, shuffle_partitions=4)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def column(spark):
    """Evaluate an expression over a list of values (one text column ``c``)."""

    def run(build, values, schema="c string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, " + schema)
        return [r[0] for r in df.coalesce(1).sort("i").select(build(F.col("c"))).collect()]

    return run
