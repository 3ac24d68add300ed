import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from millrace.session import prepare

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture
def scratch(spark):
    from millrace.session import scratch_path

    return lambda name: scratch_path(spark, name)


def rows(df, *order):
    """Rows as plain tuples, sorted by the given columns or by all."""
    out = [tuple(r) for r in df.select(*(order or df.columns), *[c for c in df.columns if order and c not in order]).collect()]
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))
