import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    import catalog  # noqa: F401  (ships the package's functions to the Python workers by value)

    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Values of a column expression over a list of single inputs."""
    from pyspark.sql import functions as F

    def run(make, values, kind="string"):
        rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
        return [r["y"] for r in rows.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]

    return run
