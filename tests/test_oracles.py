"""Registered queries against their DuckDB oracles at sf0.01 (the correctness gate).

The slowest end-to-end queries (several full jobs each) are exercised by
``test_sources_runs.py`` instead; ``python tests/oracle_harness.py`` runs all.
"""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tests.oracle_harness import compare, duck

SLOW = {
    "run_history_upsert", "run_lookup", "streaming_intake", "report_history_insights",
    "catalog_columns", "catalog_tables", "catalog_inspect", "run_results_replaced",
}
NAMES = [n for n in E.queries() if n in E.oracle_sql() and n not in SLOW]


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, name, SF001, con)
    assert result["columns_match"], result
    assert result["values_match"], result
    assert result["spark_rows"] == result["oracle_rows"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["table_name", "column_name", "rank", "value", "count"]
    assert df.count() > 0
