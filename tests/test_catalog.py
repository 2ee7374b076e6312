"""Every query against its SQL counterpart."""

import pytest

import __spark_entry__ as contract
from compare import SF_DIR, duckdb_rows, normalised
from tallybrook.plans.catalog import ORACLES, QUERIES


def test_entry_runs(spark):
    assert contract.entry(spark).limit(1).count() == 1


def test_queries_and_sql_cover_the_same_names():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    rows = [tuple(row) for row in result.collect()]
    columns, expected = duckdb_rows(ORACLES[name], SF_DIR)
    assert sorted(result.columns) == sorted(columns)
    assert expected
    assert normalised(result.columns, rows) == normalised(columns, expected)


@pytest.mark.parametrize(
    "name",
    [
        "agg_country_year",
        "agg_country_df",
        "customer_value_year",
        "topk_preview",
        "flagged_by_year",
        "flagged_detail",
        "weekly_growth",
    ],
)
def test_rows_come_in_order(spark, name):
    result = contract.queries()[name](spark, SF_DIR)
    columns, expected = duckdb_rows(contract.oracle_sql()[name], SF_DIR)
    places = [columns.index(column) for column in result.columns]
    in_order = [tuple(row[i] for i in places) for row in expected]
    assert [tuple(row) for row in result.collect()] == in_order
