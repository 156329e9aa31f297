"""Every registered query with SQL against DuckDB at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as E
from prefweave.plans.catalog import QUERIES
from tests.conftest import SF01
from tests.oracle_compare import compare

SQL = E.oracle_sql()


def test_every_preference_query_has_sql():
    assert set(QUERIES) <= set(SQL) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    problems = compare(E.queries()[name](spark, SF01), duck, SQL[name])
    assert not problems, "\n".join(problems)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["pair_id", "prompt", "chosen", "rejected"]
    assert df.count() == 14
