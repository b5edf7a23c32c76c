"""Every registered query against its DuckDB oracle (the driver's gate, run locally).

Runs on the smallest tables by default; set QUARRY_PARITY_SF to a table folder
(e.g. /root/testdata/sf0.01, the driver's scale) to check another scale.
"""

import os

import pytest

from quarry.oracle.check import compare, duck
from quarry.plans.catalog import ORACLE, QUERIES

from conftest import SMALL

PARITY_SF = os.environ.get("QUARRY_PARITY_SF", SMALL)


@pytest.fixture(scope="module")
def duck_parity():
    return duck(PARITY_SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_parity(spark, duck_parity, name):
    r = compare(QUERIES[name](spark, PARITY_SF), duck_parity, ORACLE[name])
    assert r["columns_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["spark_rows"] == r["oracle_rows"]
    assert r["values_match"], (r.get("only_spark"), r.get("only_oracle"))
    assert r["types_match"], r.get("type_diff")
