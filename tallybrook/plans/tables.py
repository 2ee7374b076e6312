"""The given tables in the shapes the operators expect."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions import Span, exact_sum, spans
from tallybrook.operators import join_shared_key, per_invoice
from tallybrook.sources import read_files


#: What the SQL counterparts add up doubles as, which is enough for the given tables.
EXACT = "decimal(24,6)"

# The given layouts; naming them spares each query a look into the files.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


@lru_cache(maxsize=256)
def _checked(path: str, name: str) -> None:
    read_files(SparkSession.active(), path, "parquet", SCHEMAS[name])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. A path is asked for its columns when it is first read."""
    path = f"{sf_dir}/{name}.parquet"
    _checked(path, name)
    return read_files(spark, path, "parquet", SCHEMAS[name], check=False)


def _day_text(pattern: str):
    return F.date_format(F.to_date("o_orderdate"), pattern)


def invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """InvoiceNo, Quantity, UnitPrice."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("InvoiceNo"),
        F.col("l_quantity").alias("Quantity"),
        F.col("l_extendedprice").alias("UnitPrice"),
    )


def invoice_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """InvoiceNo, CustomerID, InvoiceDate as ``dd-MM-yyyy`` text."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("InvoiceNo"),
        F.col("o_custkey").alias("CustomerID"),
        _day_text("dd-MM-yyyy").alias("InvoiceDate"),
    )


def customer_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CustomerID, Country."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CustomerID"), F.col("c_nationkey").alias("nation")
    )
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nation"), F.col("n_name").alias("Country")
    )
    return join_shared_key(customers, nations, "nation").drop("nation")


def invoices(spark: SparkSession, sf_dir: str, countries: bool = True) -> DataFrame:
    """One row per invoice: header, quantity, value and, if wanted, the country.

    Headers get their country before they meet the lines, and lines are summed
    per invoice, so that no join shuffles single lines.
    """
    headers = invoice_headers(spark, sf_dir)
    if countries:
        headers = join_shared_key(headers, customer_countries(spark, sf_dir), "CustomerID")
    return join_shared_key(headers, per_invoice(invoice_lines(spark, sf_dir)), "InvoiceNo")


def flight_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two tables with different columns of the same flights, keyed by ``id``."""
    orders = table(spark, sf_dir, "orders")
    place = F.col("o_orderpriority")
    first = orders.select(
        F.col("o_orderkey").alias("id"),
        place.alias("DEST"),
        F.substring(place, 3, 20).alias("DEST_CITY_NAME"),
        _day_text("d/M/yyyy").alias("FL_DATE"),
    )
    second = orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("ORIGIN"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("CANCELLED"),
    )
    return first, second


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = flight_halves(spark, sf_dir)
    return join_shared_key(first, second, "id")


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers whose ``no_employees`` text contains a number."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("answer"),
        F.col("p_type").alias("state"),
        F.col("p_brand").alias("no_employees"),
    )


def country_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country, order key, date and value of every order."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("CustomerID"),
        "o_orderkey",
        F.to_date("o_orderdate").alias("order_day"),
        F.col("o_totalprice").alias("InvoiceValue"),
    )
    joined = join_shared_key(orders, customer_countries(spark, sf_dir), "CustomerID")
    return joined.select("Country", "o_orderkey", "order_day", "InvoiceValue")


def order_values(spark: SparkSession, sf_dir: str) -> Span | None:
    """The span of the order values, from one column of the scan."""
    return spans(table(spark, sf_dir, "orders"), {"value": "o_totalprice"})["value"]


def weekly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country, WeekNumber (the week's Monday), InvoiceValue; unique per country and week."""
    orders = country_orders(spark, sf_dir)
    return (
        orders.groupBy("Country", F.trunc("order_day", "week").alias("WeekNumber"))
        .agg(exact_sum(orders, "InvoiceValue", span=order_values(spark, sf_dir)).alias("InvoiceValue"))
    )
