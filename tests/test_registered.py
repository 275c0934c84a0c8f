"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
import check_oracle  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF)


@pytest.mark.skipif(not Path(SF).exists(), reason="tables not present")
@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_equals_sql(spark, con, name):
    wrong, *_ = check_oracle.compare(spark, con, name, SF)
    assert wrong is None, wrong


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not Path(SF).exists(), reason="tables not present")
def test_entry(spark):
    assert entry.entry(spark).count() == 109
