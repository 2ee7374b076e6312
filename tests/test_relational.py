import pytest
from pyspark.sql import functions as F

from tallybrook.operators import (
    counted,
    flagged_detail,
    flagged_per_year,
    join_shared_key,
    partition_count,
    per_invoice,
    preview,
    rows_per_partition,
    size_at_least,
    size_in_form,
    spread,
    summarise_invoices,
    summarise_sales,
)


def _rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_join_shared_key(spark):
    left = spark.createDataFrame([(1, "x"), (None, "n"), (2, "y")], "id int, a string")
    right = spark.createDataFrame([(1, "p"), (1, "q"), (None, "z")], "id int, b string")
    joined = join_shared_key(left, right, "id")
    assert joined.columns == ["id", "a", "b"]
    assert _rows(joined) == [(1, "x", "p"), (1, "x", "q")]


def test_the_partition_of_a_hot_key_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    # A third of all rows has one key. Sizes are compared compressed, hence the hash.
    rows = spark.range(0, 300_000, 1, 8)
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    left = rows.select(key.alias("id"), F.xxhash64(rows["id"]).alias("a"))
    right = rows.filter("id % 3 != 0 or id = 0").withColumn("b", F.col("id") + 1)
    try:
        for setting, value in settings.items():
            spark.conf.set(setting, value)
        joined = join_shared_key(left, right, "id")
        assert len(joined.collect()) == 300_000
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for setting, value in before.items():
            if value is None:
                spark.conf.unset(setting)
            else:
                spark.conf.set(setting, value)
    assert "SortMergeJoin(skew=true)" in plan


def test_join_names_columns_that_would_be_ambiguous(spark):
    left = spark.createDataFrame([(1, "x")], "id int, a string")
    with pytest.raises(ValueError, match="'a'"):
        join_shared_key(left, left, "id")


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(
        [
            ("A", "c1", 1, 2, 1.5),
            ("A", "c1", 1, 1, 0.5),
            ("A", None, 2, 4, 2.0),
            ("B", "c2", 3, 1, 10.25),
            (None, None, None, 5, 1.0),
            (None, "c3", 4, None, 1.0),
        ],
        "Country string, CustomerID string, InvoiceNo int, Quantity int, UnitPrice double",
    )


def test_whole_table_measures(lines):
    assert _rows(summarise_sales(lines, price_digits=4)) == [(6, 13, 2.7083, 4, 26.75)]


def test_group_measures_keep_the_null_group(lines):
    names = ["num_invoices", "total_quantity", "invoice_value"]
    assert _rows(summarise_sales(lines, ["Country"], names)) == [
        ("A", 2, 7, 11.5),
        ("B", 1, 1, 10.25),
        (None, 1, 5, 5.0),
    ]


def test_summing_per_invoice_first_gives_the_same(lines):
    names = ["num_invoices", "total_quantity", "invoice_value"]
    headers = lines.select("InvoiceNo", "Country").distinct()
    direct = join_shared_key(lines.drop("Country", "CustomerID"), headers, "InvoiceNo")
    early = join_shared_key(headers, per_invoice(lines), "InvoiceNo")
    assert _rows(summarise_invoices(early, ["Country"], names)) == _rows(
        summarise_sales(direct, ["Country"], names)
    )


@pytest.fixture(scope="module")
def flights(spark):
    return spark.createDataFrame(
        [
            (1, "X", "Rome", "1/2/2000", 1),
            (2, "X", "Rome", "11/12/2000", 1),
            (3, "X", "Rome", "2000-01-01", 1),
            (4, "X", "Oslo", "3/2/2000", 1),
            (5, "Y", "Rome", "3/2/2001", 1),
            (6, "Y", "Rome", "3/2/2000", 0),
            (7, "Y", "Rome", None, 1),
        ],
        "id int, DEST string, CITY string, FL_DATE string, CANCELLED int",
    )


def test_flagged_per_year(flights):
    counts = flagged_per_year(flights, "DEST", "CANCELLED", "FL_DATE", year="y", count="n")
    assert _rows(counts) == [("X", 2000, 3), ("Y", 2001, 1)]


def test_flagged_detail(flights):
    found = flagged_detail(flights, "CANCELLED", "FL_DATE", 2000, {"CITY": "Rome"})
    assert _rows(found.select("id", "FL_DATE")) == [(1, "2000-02-01"), (2, "2000-12-11")]


@pytest.fixture(scope="module")
def survey(spark):
    sizes = ["6-25", "More than 1000", "500-1000", "26-100", "", None, "about 700", "More than 10"]
    return spark.createDataFrame([(s,) for s in sizes], "size string")


def test_size_at_least(survey):
    assert _rows(size_at_least(survey, "size", 500)) == [
        ("500-1000",),
        ("More than 1000",),
        ("about 700",),
    ]


def test_size_in_form(survey):
    text = F.col("size")
    forms = [(text.like("More than%"), 500), (F.regexp_like(text, F.lit(r"^\d+-\d+$")), 500)]
    assert _rows(size_in_form(survey, "size", forms)) == [("500-1000",), ("More than 1000",)]


def test_preview_orders_and_cuts(spark):
    df = spark.range(100).withColumn("v", F.col("id") % 10)
    top = preview(df, [F.desc("v"), "id"], 3)
    assert [tuple(row) for row in top.collect()] == [(9, 9), (19, 9), (29, 9)]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_counting_on_the_way(spark, tmp_path):
    df, seen = counted(spark.range(1000).filter("id % 4 = 0"))
    df.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"num_rows": 250}


def test_spread(spark):
    df = spark.range(0, 1000, 1, 3)
    counts = [row.num_rows for row in rows_per_partition(spread(df, 5)).collect()]
    assert len(counts) == 5 and sum(counts) == 1000 and max(counts) - min(counts) <= 3
    assert partition_count(df) == 3
    assert spread(df).count() == 1000
