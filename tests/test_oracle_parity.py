"""Every registered query against its DuckDB oracle (the driver's gate, at sf0.001)."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from strata.plans.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.parity import compare, duck

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) >= set(NAMES)
    assert set(queries()) >= set(NAMES)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["order_date", "country", "order_count", "customer_count", "gross_revenue", "avg_order_value"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, name, queries()[name], oracle_sql().get(name), SF_SMALL, con)
    assert result["status"] == "ok", result
