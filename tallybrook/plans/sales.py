"""Invoice aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions import Addend, exact_sum, in_words, text_year
from tallybrook.operators import preview, summarise_invoices, summarise_sales
from tallybrook.plans import tables
from tallybrook.plans.tables import EXACT
from tallybrook.sources import literal_table, run_sql

# The order dates of the tables run from 1995 to 2001.
SALES_YEAR = 1997

_COUNTRY_MEASURES = ["num_invoices", "total_quantity", "invoice_value"]


def _by_value_then(df: DataFrame, *keys: str) -> DataFrame:
    return df.orderBy(F.desc("invoice_value"), *keys)


def agg_country_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales per country and year, largest first."""
    sales = summarise_invoices(
        tables.invoices(spark, sf_dir), ["Country", text_year("InvoiceDate").alias("year")]
    )
    return _by_value_then(sales, "Country", "year")


def agg_country_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales per country, largest first."""
    sales = summarise_invoices(tables.invoices(spark, sf_dir), ["Country"], _COUNTRY_MEASURES)
    return _by_value_then(sales, "Country")


def agg_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All measures over the whole line table."""
    return summarise_sales(tables.invoice_lines(spark, sf_dir), price_digits=6)


def customer_value_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value per customer in one year, largest first."""
    invoices = tables.invoices(spark, sf_dir, countries=False)
    in_year = invoices.filter(text_year("InvoiceDate").try_cast("int") == SALES_YEAR)
    return _by_value_then(
        summarise_invoices(in_year, ["CustomerID"], ["invoice_value"]), "CustomerID"
    )


def topk_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest invoices."""
    invoices = tables.invoices(spark, sf_dir, countries=False)
    value = F.round(Addend.value(invoices, "InvoiceValue"), 2)
    rows = invoices.select("InvoiceNo", "CustomerID", value.alias("invoice_value"))
    return preview(rows, [F.desc("invoice_value"), "InvoiceNo"])


def indicator_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 0/1 column from a text in any case."""
    return tables.table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_mktsegment",
        in_words("c_mktsegment", ["building", "b"]).alias("num_building"),
    )


def indicator_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 0/1 column summed per nation, in SQL text over a frame."""
    return run_sql(
        spark,
        """
        SELECT c_nationkey, count(*) AS num_records,
               sum(if(array_contains(:words, lower(c_mktsegment)), 1, 0)) AS num_building
        FROM {customers}
        GROUP BY c_nationkey
        """,
        args={"words": ["building", "b"]},
        customers=tables.table(spark, sf_dir, "customer"),
    )


def literal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and their value per name in a table written out in the program."""
    named = literal_table(
        spark, [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3)], ["Name", "Age"]
    )
    orders = tables.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("Name"), "o_totalprice"
    )
    # Three rows, whatever the size of the orders.
    value = exact_sum(orders, "o_totalprice")
    return (
        orders.join(F.broadcast(named), "Name", "inner")
        .groupBy("Name", "Age")
        .agg(
            F.count(F.lit(1)).alias("num_records"),
            value.alias("order_value"),
        )
    )


# The values are added up as DECIMAL, which loses nothing of the given ones.
_VALUE_SQL = f"round(CAST(sum(CAST(l_quantity * l_extendedprice AS {EXACT})) AS DOUBLE), 2)"
_INVOICES_SQL = """
    SELECT n_name AS Country, o_custkey AS CustomerID, o_orderkey AS InvoiceNo,
           l_quantity AS Quantity, l_extendedprice AS UnitPrice,
           strftime(o_orderdate, '%d-%m-%Y') AS InvoiceDate
    FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey
"""

ORACLES = {
    "agg_country_year": f"""
        SELECT Country, substr(InvoiceDate, 7, 4) AS year,
               count(DISTINCT InvoiceNo) AS num_invoices, sum(Quantity) AS total_quantity,
               {_VALUE_SQL.replace("l_quantity", "Quantity").replace("l_extendedprice", "UnitPrice")} AS invoice_value
        FROM ({_INVOICES_SQL}) GROUP BY Country, substr(InvoiceDate, 7, 4)
        ORDER BY invoice_value DESC, Country, year
    """,
    "agg_country_df": f"""
        SELECT Country, count(DISTINCT InvoiceNo) AS num_invoices,
               sum(Quantity) AS total_quantity,
               {_VALUE_SQL.replace("l_quantity", "Quantity").replace("l_extendedprice", "UnitPrice")} AS invoice_value
        FROM ({_INVOICES_SQL}) GROUP BY Country ORDER BY invoice_value DESC, Country
    """,
    "agg_global": f"""
        SELECT count(*) AS num_records, sum(l_quantity) AS total_quantity,
               round(CAST(sum(CAST(l_extendedprice AS {EXACT})) AS DOUBLE)
                     / count(l_extendedprice), 6) AS avg_price,
               count(DISTINCT l_orderkey) AS num_invoices,
               {_VALUE_SQL} AS invoice_value
        FROM lineitem
    """,
    "customer_value_year": f"""
        SELECT o_custkey AS CustomerID,
               {_VALUE_SQL} AS invoice_value
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        WHERE try_cast(substr(strftime(o_orderdate, '%d-%m-%Y'), 7, 4) AS INTEGER) = {SALES_YEAR}
        GROUP BY o_custkey ORDER BY invoice_value DESC, CustomerID
    """,
    "topk_preview": f"""
        SELECT o_orderkey AS InvoiceNo, o_custkey AS CustomerID,
               {_VALUE_SQL} AS invoice_value
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        GROUP BY o_orderkey, o_custkey ORDER BY invoice_value DESC, InvoiceNo LIMIT 20
    """,
    "indicator_flag": """
        SELECT c_custkey, c_mktsegment,
               CASE WHEN lower(c_mktsegment) IN ('building', 'b') THEN 1 ELSE 0 END AS num_building
        FROM customer
    """,
    "indicator_totals": """
        SELECT c_nationkey, count(*) AS num_records,
               CAST(sum(CASE WHEN lower(c_mktsegment) IN ('building', 'b') THEN 1 ELSE 0 END)
                    AS BIGINT) AS num_building
        FROM customer GROUP BY c_nationkey
    """,
    "literal_rows": f"""
        SELECT Name, Age, count(*) AS num_records,
               round(CAST(sum(CAST(o_totalprice AS {EXACT})) AS DOUBLE), 2) AS order_value
        FROM (VALUES ('1-URGENT', CAST(1 AS BIGINT)), ('2-HIGH', 2), ('3-MEDIUM', 3)) v(Name, Age)
        JOIN orders ON o_orderpriority = Name GROUP BY Name, Age
    """,
}
