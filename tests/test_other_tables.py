"""The queries on tables with gaps, and on tables that are folders of files."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from compare import SF_DIR, duckdb_rows, normalised
from tallybrook.plans.catalog import QUERIES
from tallybrook.plans.tables import SCHEMAS, table

BATCH = sorted(name for name in QUERIES if not name.startswith("stream_"))
STREAMS = sorted(name for name in QUERIES if name.startswith("stream_"))


def _changed(df, changes):
    """Set each column to a value in every n-th row, going by a hash of the row."""
    row = F.struct(*df.columns)
    return df.withColumns(
        {
            column: F.when(F.pmod(F.xxhash64(row, F.lit(column)), F.lit(number)) == 0, F.lit(value))
            .otherwise(F.col(column))
            .cast(df.schema[column].dataType)
            for column, (number, value) in changes.items()
        }
    )


_GAPS = {
    "orders": [
        {"o_custkey": (7, None), "o_totalprice": (5, None), "o_orderdate": (9, None)},
        {"o_totalprice": (4, 0.0), "o_orderpriority": (6, None)},
        # A third of all orders of one customer.
        {"o_custkey": (3, 1), "o_orderstatus": (8, None)},
    ],
    "lineitem": [
        {"l_quantity": (7, None), "l_extendedprice": (6, None), "l_returnflag": (5, None)},
        # A third of all lines on one invoice.
        {"l_orderkey": (3, 2)},
        {"l_orderkey": (11, None)},
    ],
    "customer": [{"c_nationkey": (6, None), "c_mktsegment": (4, None)}],
    "part": [{"p_brand": (4, None)}, {"p_brand": (5, "Brand#")}, {"p_brand": (5, "")}],
    "nation": [],
}


@pytest.fixture(scope="module")
def gaps_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("gaps")
    for name, rounds in _GAPS.items():
        df = table(spark, SF_DIR, name)
        for changes in rounds:
            df = _changed(df, changes)
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def _matches(spark, name, folder):
    result = contract.queries()[name](spark, folder)
    columns, expected = duckdb_rows(contract.oracle_sql()[name], folder)
    assert expected
    rows = [tuple(row) for row in result.collect()]
    assert normalised(result.columns, rows) == normalised(columns, expected)


@pytest.mark.parametrize("name", BATCH)
def test_tables_with_gaps_and_hot_keys(spark, gaps_dir, name):
    _matches(spark, name, gaps_dir)


@pytest.fixture(scope="module")
def folders_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("folders")
    for name in SCHEMAS:
        table(spark, SF_DIR, name).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["agg_country_year", "order_growth", *STREAMS])
def test_tables_in_several_files(spark, folders_dir, name):
    _matches(spark, name, folders_dir)
