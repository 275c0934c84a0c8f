import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from quern.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def one(spark):
    """Evaluate a column over a single text."""
    def run(column, value, name="t", kind="string"):
        return spark.createDataFrame([(value,)], f"{name} {kind}").select(column.alias("r")).first()["r"]

    return run
