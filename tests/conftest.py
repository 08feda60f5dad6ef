import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    import __spark_entry__  # noqa: F401

    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate column expressions on one row of literals: one(value=..., expr)."""

    def run(build, **values):
        from pyspark.sql import functions as F

        ddl = values.pop("ddl", None)
        row = spark.createDataFrame([tuple(values.values())], ddl or ", ".join(f"{k} string" for k in values))
        return row.select(build(*[F.col(k) for k in values]).alias("out")).first()["out"]

    return run
