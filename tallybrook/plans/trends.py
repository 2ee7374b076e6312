"""Row numbers, growth and running totals per country."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.operators import add_growth, cut_by_range, cut_evenly, number_rows
from tallybrook.plans import tables
from tallybrook.plans.tables import EXACT


def row_number_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks numbered per country; a country has one row per calendar week."""
    return number_rows(tables.weekly_summary(spark, sf_dir), ["Country"], ["WeekNumber"])


def weekly_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Growth over the previous week and the running total per country."""
    weeks = tables.weekly_summary(spark, sf_dir)
    return add_growth(weeks, ["Country"], ["WeekNumber"], "InvoiceValue").orderBy(
        "Country", "WeekNumber"
    )


def _sliced_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders with a ``slice``, by bounds read from one column of the scan."""
    keys = tables.table(spark, sf_dir, "orders").select("o_orderkey")
    return cut_evenly(tables.country_orders(spark, sf_dir), "o_orderkey", "slice", keys=keys)


def row_number_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order numbered within its country, in slices of the order key."""
    orders = _sliced_orders(spark, sf_dir)
    return number_rows(orders, ["Country"], ["o_orderkey"], slices=["slice"]).drop("slice")


def order_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Growth and running total over every order of a country, in slices."""
    orders = _sliced_orders(spark, sf_dir)
    return add_growth(
        orders, ["Country"], ["o_orderkey"], "InvoiceValue", slices=["slice"], span=tables.order_values(spark, sf_dir)
    ).drop("slice")


_BY_DAY = ["order_day", "priority", "o_orderkey"]


def growth_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number, growth and running total of every order of a status, by day, priority and key.

    A status has up to half of all orders; they are cut by ranges of a date, a text and a
    number together.
    """
    orders = tables.table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("Country"),
        F.to_date("o_orderdate").alias("order_day"),
        F.col("o_orderpriority").alias("priority"),
        "o_orderkey",
        F.col("o_totalprice").alias("InvoiceValue"),
    )
    cut = cut_by_range(orders, ["Country"], _BY_DAY, "slice")
    numbered = number_rows(cut, ["Country"], _BY_DAY, slices=["slice"])
    grown = add_growth(
        numbered, ["Country"], _BY_DAY, "InvoiceValue", slices=["slice"], span=tables.order_values(spark, sf_dir)
    )
    return grown.drop("slice")


_ORDERS_SQL = """
    SELECT n_name AS Country, o_orderkey, CAST(o_orderdate AS DATE) AS order_day,
           o_totalprice AS InvoiceValue
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
"""
_WEEKS_SQL = f"""
    SELECT Country, CAST(date_trunc('week', order_day) AS DATE) AS WeekNumber,
           round(CAST(sum(CAST(InvoiceValue AS {EXACT})) AS DOUBLE), 2) AS InvoiceValue
    FROM ({_ORDERS_SQL}) GROUP BY Country, date_trunc('week', order_day)
"""


def _growth_sql(source: str, order: str) -> str:
    # NULLs come first, as in Spark; adding 0.0 turns a rounded -0.0 into 0.0.
    return f"""
        SELECT * EXCLUDE (earlier, running),
               CASE WHEN earlier = 0 AND InvoiceValue IS NOT NULL THEN NULL
                    ELSE coalesce(round((InvoiceValue - earlier) / earlier * 100, 2) + 0.0, 0)
               END AS PercentGrowth,
               round(CAST(running AS DOUBLE), 2) AS AccumulateValue
        FROM (
            SELECT *,
                   lag(InvoiceValue) OVER (
                       PARTITION BY Country ORDER BY {order} NULLS FIRST) AS earlier,
                   sum(CAST(InvoiceValue AS {EXACT})) OVER (
                       PARTITION BY Country ORDER BY {order} NULLS FIRST
                       ROWS UNBOUNDED PRECEDING) AS running
            FROM ({source})
        )
        ORDER BY Country, {order}
    """


def _number_sql(source: str, order: str) -> str:
    return f"""
        SELECT *, row_number() OVER (PARTITION BY Country ORDER BY {order} NULLS FIRST) AS RowNum
        FROM ({source})
    """


_DAYS_SQL = """
    SELECT *, row_number() OVER (PARTITION BY Country ORDER BY order_day NULLS FIRST, priority NULLS FIRST,
                                 o_orderkey NULLS FIRST) AS RowNum
    FROM (SELECT o_orderstatus AS Country, CAST(o_orderdate AS DATE) AS order_day, o_orderpriority AS priority,
                 o_orderkey, o_totalprice AS InvoiceValue FROM orders)
"""


ORACLES = {
    "growth_by_day": _growth_sql(_DAYS_SQL, "order_day NULLS FIRST, priority NULLS FIRST, o_orderkey"),
    "row_number_by_group": _number_sql(_WEEKS_SQL, "WeekNumber"),
    "weekly_growth": _growth_sql(_WEEKS_SQL, "WeekNumber"),
    "row_number_orders": _number_sql(_ORDERS_SQL, "o_orderkey"),
    "order_growth": _growth_sql(_ORDERS_SQL, "o_orderkey"),
}
