import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from nassaj.shipping import ship  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.default.parallelism", "2")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    ship(session)
    yield session


@pytest.fixture
def one(spark):
    """Value of a column function on one text."""

    def run(op, value, kind="string"):
        from pyspark.sql import functions as F

        return spark.createDataFrame([(value,)], f"v {kind}").select(op(F.col("v")).alias("r")).first()["r"]

    return run


def plan_of(df) -> str:
    """The executed plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
