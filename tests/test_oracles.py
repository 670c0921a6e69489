"""Every registered query against its DuckDB oracle (the driver's check), on sf0.001."""

import pytest

import __spark_entry__ as E
from stratum.plans.registry import ORACLES, QUERIES
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
WINDOWED = {"run_history"}  # a 2-hour look-back holds ~3 events at this scale; may be empty


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert info["ok"] is not False, info
    if name not in WINDOWED:
        assert info["rows"] > 0, info
