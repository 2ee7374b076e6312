"""The registered queries against SQL, and on empty tables."""

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from compare import SF_DIR, duckdb_rows, normalised
from tallybrook.llm.catalog import ORACLES, QUERIES

TABLES = ("documents", "labels", "benchmark", "pages", "conversations", "embeddings")


def test_all_are_registered():
    names = set(contract.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    rows = [tuple(row) for row in result.collect()]
    columns, expected = duckdb_rows(ORACLES[name], SF_DIR)
    assert sorted(result.columns) == sorted(columns)
    assert normalised(result.columns, rows) == normalised(columns, expected)


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for name in TABLES:
        df = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
        df.limit(0).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, empty_dir, name):
    rows = QUERIES[name](spark, empty_dir).collect()
    # The probe conversation is always there.
    assert len(rows) == (1 if name == "op8_chat" else 0)


def test_pipeline_on_empty_tables(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).collect() == []
