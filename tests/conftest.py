import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("OFF")
    yield session


@pytest.fixture
def one(spark):
    """Value of an expression over a one-row table of text columns."""
    def evaluate(expression, **columns):
        df = spark.createDataFrame([tuple(columns.values())], ", ".join(f"`{c}` string" for c in columns))
        return df.select(expression.alias("v")).first()["v"]
    return evaluate


@pytest.fixture
def values(spark):
    """Values of one expression over a column ``x`` of texts, in order."""
    def evaluate(expression, inputs):
        df = spark.createDataFrame(list(enumerate(inputs)), "i int, x string")
        return [r["v"] for r in df.select("i", expression.alias("v")).orderBy("i").collect()]
    return evaluate
