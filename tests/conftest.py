import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from jobloom.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="jobloom-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def make_postings(spark):
    """Postings from dicts; fields left out stay blank, order is list order."""
    from jobloom import fixed_values as fv

    def make(*rows):
        shape = "ord bigint, " + ", ".join(f"{name} string" for name in fv.POSTING_FIELDS)
        data = [
            (i, *[row.get(name, "") for name in fv.POSTING_FIELDS]) for i, row in enumerate(rows)
        ]
        return spark.createDataFrame(data, shape)

    return make
