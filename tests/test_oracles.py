"""Every registered query against its SQL twin on the same parquet files."""

import pytest
from compare import differences, oracle
from workload.oracles import ORACLES
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_small):
    return oracle(sf_small)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_result(spark, sf_small, con, name):
    assert differences(QUERIES[name](spark, sf_small), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf_small, name):
    assert QUERIES[name](spark, sf_small).count() > 0
