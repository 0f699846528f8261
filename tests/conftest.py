import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = sys.path[0] + os.pathsep + os.environ.get("PYTHONPATH", "")

from postsieve.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(**{
        "spark.master": "local[4]", "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false", "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate a text expression on one value."""
    from pyspark.sql import functions as F

    def run(value, expression):
        df = spark.createDataFrame([(value,)], "v string")
        return df.select(expression(F.col("v")).alias("r")).first()["r"]

    return run
