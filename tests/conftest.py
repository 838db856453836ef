import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).parent.parent
sys.path.insert(0, str(ROOT))
# Extractors of the tests have to be importable in the Python workers.
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), str(ROOT / "tests"), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def column(spark):
    """Evaluate one column expression over a list of values: value -> result."""

    def evaluate(values, make, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {kind}")
        return [r.x for r in df.select("i", make("v").alias("x")).orderBy("i").collect()]

    return evaluate
