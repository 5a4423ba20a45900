"""Catalogue queries against their DuckDB oracles on the smallest driver tables."""

import pytest

from riskfold.plans.catalog import ORACLES, QUERIES, oracles
from riskfold.plans.checker import compare, duck_connect

SF = "/root/testdata/sf0.001"
@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


@pytest.fixture(scope="module")
def sql():
    return oracles()


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_oracle(spark, con, sql, name):
    r = compare(QUERIES[name](spark, SF), sql[name], con)
    assert r["cols_match"] and r["rows"][0] == r["rows"][1] and r["hash_match"], r
