"""Physical plans that have to hold for tables of any size."""

import re

import pytest

import __spark_entry__ as contract
from compare import SF_DIR
from tallybrook.plans.catalog import QUERIES


@pytest.fixture
def plan(spark):
    """Plans as they are when only the smallest table may be broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    # Above the nations' 25 rows, below every table that grows.
    spark.conf.set(key, "4000")

    def explained(name):
        df = contract.queries()[name](spark, SF_DIR)
        return df._jdf.queryExecution().executedPlan().toString()

    yield explained
    spark.conf.set(key, before)


BATCH = sorted(name for name in QUERIES if not name.startswith("stream_"))


@pytest.mark.parametrize("name", BATCH)
def test_no_plan_pairs_rows_without_a_key(plan, name):
    text = plan(name)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "InPandas" not in text


@pytest.mark.parametrize("name", ["agg_country_year", "agg_country_df", "customer_value_year"])
def test_lines_are_summed_before_they_are_shuffled(plan, name):
    text = plan(name)
    lines = text[text.index("InvoiceNo", text.index("HashAggregate(keys=[InvoiceNo")) :]
    assert re.search(
        r"HashAggregate\(keys=\[InvoiceNo#\d+L\][^\n]*\n[ :|]*\+- Exchange hashpartitioning\(InvoiceNo"
        r"[^\n]*\n[ :|]*\+- HashAggregate\(keys=\[InvoiceNo#\d+L\], functions=\[partial_",
        text,
    ), lines


def test_counting_invoices_reuses_the_partitioning_of_the_join(plan):
    text = plan("agg_country_year")
    # The two joins shuffle both sides, then comes the result and its order.
    assert len(re.findall(r"Exchange (?:hash|range)partitioning", text)) == 6
    assert len(re.findall(r"BroadcastExchange", text)) == 1


@pytest.mark.parametrize(
    "name, columns",
    [
        ("agg_global", {"l_orderkey", "l_quantity", "l_extendedprice"}),
        ("join_count", {"o_orderkey"}),
        ("indicator_totals", {"c_nationkey", "c_mktsegment"}),
        ("regex_size_filter", {"p_partkey", "p_type", "p_brand"}),
        ("row_number_by_group", None),
    ],
)
def test_scans_read_only_what_is_used(plan, name, columns):
    text = plan(name)
    read = set(re.findall(r"(\w+):", " ".join(re.findall(r"ReadSchema: struct<([^>]*)", text))))
    if columns is None:
        assert "o_orderpriority" not in read and "c_name" not in read
    else:
        assert read == columns


def test_flags_are_filtered_below_the_join(plan):
    text = plan("flagged_by_year")
    assert text.index("SortMergeJoin") < text.index("o_orderstatus")
    assert "Filter (((o_orderstatus" in text


def test_growth_and_total_share_one_window(plan):
    text = plan("weekly_growth")
    assert len(re.findall(r"\+- Window", text)) == 1
    assert len(re.findall(r"lag\(", text)) == 1


def test_large_windows_partition_by_slice(plan):
    text = plan("order_growth")
    assert re.search(r"Exchange hashpartitioning\(Country#\d+, _slice0#\d+", text)


def test_preview_does_not_sort_everything(plan):
    text = plan("topk_preview")
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text
