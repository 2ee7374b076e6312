"""Joins of bucketed tables, and columns found for documents."""

import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from compare import SF_DIR
from tallybrook.operators.discovery import Field, discover_fields, typed_documents
from tallybrook.plans.storage import join_bucketed
from tallybrook.sinks import bucket_skew, join_buckets, write_bucketed


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_join_of_buckets_has_no_exchange(spark):
    joined = join_bucketed(spark, SF_DIR)
    assert "Exchange" not in _plan(joined) and "SortMergeJoin" in _plan(joined)
    # A filter and a few columns reach the scans of both sides.
    few = joined.filter("id > 100").select("id", "DEST")
    assert "Exchange" not in _plan(few) and _plan(few).count("GreaterThan(id,100)") == 2


def _stored(spark, tmp_path, df):
    name = f"t_{uuid.uuid4().hex}"
    write_bucketed(df, name, f"{tmp_path}/{name}", "id", 4)
    return name


def test_a_hot_bucket_is_joined_with_an_exchange(spark, tmp_path):
    even = spark.range(2000).withColumn("a", F.sha2(F.col("id").cast("string"), 256))
    hot = spark.range(40_000).select(F.lit(0).cast("bigint").alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("b"))
    rows = hot.union(spark.range(1, 9).select("id", F.lit("few").alias("b")))
    left, right = _stored(spark, tmp_path, even), _stored(spark, tmp_path, rows)
    assert bucket_skew(spark, left) < 1.5 < 3 < bucket_skew(spark, right)
    assert bucket_skew(spark, _stored(spark, tmp_path, hot)) == 4.0
    joined = join_buckets(spark, left, right, "id", most_skew=2.0)
    assert "Exchange" in _plan(joined)
    assert joined.count() == join_buckets(spark, left, right, "id", most_skew=9.0).count() == 40_008


def test_nulls_repeats_and_empty_tables_of_buckets(spark, tmp_path):
    first = spark.createDataFrame([(None, "x"), (1, "a"), (1, "b"), (2, None)], "id bigint, a string")
    second = spark.createDataFrame([(None, "y"), (1, "c"), (1, "d"), (3, "e")], "id bigint, b string")
    left, right = _stored(spark, tmp_path, first), _stored(spark, tmp_path, second)
    found = sorted(tuple(row) for row in join_buckets(spark, left, right, "id").collect())
    assert found == [(1, "a", "c"), (1, "a", "d"), (1, "b", "c"), (1, "b", "d")]
    empty = _stored(spark, tmp_path, second.limit(0))
    assert join_buckets(spark, left, empty, "id").count() == 0


DOCS = [
    (1, '{"k":1,"u":123456789012345678901234567890,"m":1,"d":1.5,"o":{"a":1}}'),
    (2, '{"k":2,"u":5,"m":"x","d":2,"n":null}'),
    (3, "[1]"), (4, None), (5, "{}"), (6, '{"k":9007199254740993,"o":[1]}'), (6, '{"k":9007199254740993,"o":[1]}'),
]


def test_fields_are_found_and_typed(spark):
    docs = spark.createDataFrame(DOCS, "id int, value string")
    fields = discover_fields(docs)
    kinds = {field.name: (field.type.split("(")[0], field.num_documents) for field in fields}
    assert kinds == {
        "d": ("DECIMAL", 2), "k": ("BIGINT", 4), "m": ("VARIANT", 2), "n": ("VARIANT", 1), "o": ("VARIANT", 3), "u": ("DECIMAL", 2)
    }
    rows = typed_documents(docs, fields).orderBy("id").collect()
    assert [row.k for row in rows] == [1, 2, None, None, None, 9007199254740993, 9007199254740993]
    assert rows[0].u == Decimal("123456789012345678901234567890") and rows[0].d == Decimal("1.5")
    assert [row.rest for row in rows] == [{}, {}, None, None, {}, {}, {}]


def test_what_has_no_column_or_does_not_fit_is_in_the_rest(spark):
    docs = spark.createDataFrame(DOCS[:2] + [(7, '{"k":"text","d":0.25,"f":1e300}'), (8, '{"f":9007199254740993,"k":null}')], "id int, value string")
    fields = [Field("k", "BIGINT", 1), Field("d", "DECIMAL(10,1)", 1), Field("f", "DOUBLE", 1)]
    rows = {row.id: row for row in typed_documents(docs, fields).collect()}
    assert rows[1].rest == {"u": "123456789012345678901234567890", "m": "1", "o": '{"a":1}'} and rows[1].d == Decimal("1.5")
    assert rows[7].rest == {"k": '"text"', "d": "0.25"} and rows[7].k is None and rows[7].f == 1e300
    assert rows[8].rest == {"f": "9007199254740993"} and rows[8].k is None
    whole = typed_documents(docs, [Field("d", "BIGINT", 1)])
    assert {row.id: row.rest.get("d") for row in whole.collect()} == {1: "1.5", 2: None, 7: "0.25", 8: None}


def test_seldom_fields_get_no_column(spark):
    docs = spark.range(1000).select(F.concat(F.lit('{"all":1,"f'), F.col("id"), F.lit('":2}')).alias("value"))
    fields = discover_fields(docs)
    assert [(field.name, field.num_documents) for field in fields] == [("all", 1000)]
    row = typed_documents(docs, fields).filter(F.size("rest") != 1).count()
    assert row == 0


def test_clashing_names_and_no_documents(spark):
    docs = spark.createDataFrame([(1, '{"ID":1}')], "id int, value string")
    with pytest.raises(ValueError, match="id"):
        typed_documents(docs, discover_fields(docs))
    twice = spark.createDataFrame([('{"a":1,"A":2}',)], "value string")
    with pytest.raises(ValueError, match="a"):
        typed_documents(twice, discover_fields(twice))
    none = docs.limit(0)
    assert discover_fields(none) == [] and typed_documents(none, []).columns == ["id", "rest"]
