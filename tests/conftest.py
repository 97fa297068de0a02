import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from newsloom.session import ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate one column expression over literal inputs."""
    from pyspark.sql import functions as F

    def run(build, *values):
        cols = [F.lit(v).alias(f"c{i}") for i, v in enumerate(values)]
        row = spark.range(1).select(*cols) if cols else spark.range(1)
        return row.select(build(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()["x"]

    return run
