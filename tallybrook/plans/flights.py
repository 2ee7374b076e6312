"""A join of two files on a shared key and what is asked of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions import parsed_date
from tallybrook.operators import flagged_detail as flagged_detail_rows
from tallybrook.operators import flagged_per_year
from tallybrook.plans import tables

FLIGHT_YEAR = 2000
CITY = "URGENT"


def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.flights(spark, sf_dir)


def join_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the join; only the keys are read."""
    return tables.flights(spark, sf_dir).agg(F.count(F.lit(1)).alias("num_rows"))


def flagged_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cancelled flights per destination and year."""
    counts = flagged_per_year(
        tables.flights(spark, sf_dir),
        "DEST",
        "CANCELLED",
        "FL_DATE",
        year="FL_YEAR",
        count="NUM_CANCELLED_FLIGHT",
    )
    return counts.orderBy("DEST", "FL_YEAR")


def flagged_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cancelled flights of one year to one city, latest first."""
    found = flagged_detail_rows(
        tables.flights(spark, sf_dir),
        "CANCELLED",
        "FL_DATE",
        FLIGHT_YEAR,
        {"DEST_CITY_NAME": CITY},
    )
    return found.select(
        "id", "DEST", "DEST_CITY_NAME", "FL_DATE", "ORIGIN", "CANCELLED"
    ).orderBy(F.desc("FL_DATE"), "id")


def parsed_date_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice headers with their date text parsed."""
    return tables.invoice_headers(spark, sf_dir).withColumn(
        "date_parsed", parsed_date("InvoiceDate", "dd-MM-yyyy")
    )


_FLIGHTS_SQL = """
    SELECT a.id, DEST, DEST_CITY_NAME, FL_DATE, ORIGIN, CANCELLED
    FROM (SELECT o_orderkey AS id, o_orderpriority AS DEST,
                 substr(o_orderpriority, 3, 20) AS DEST_CITY_NAME,
                 strftime(o_orderdate, '%-d/%-m/%Y') AS FL_DATE FROM orders) a
    JOIN (SELECT o_orderkey AS id, o_custkey AS ORIGIN,
                 CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS CANCELLED FROM orders) b
      ON a.id = b.id
"""
_DAY_SQL = "try_strptime(FL_DATE, '%-d/%-m/%Y')"

ORACLES = {
    "join_inner": _FLIGHTS_SQL,
    "join_count": f"SELECT count(*) AS num_rows FROM ({_FLIGHTS_SQL})",
    "flagged_by_year": f"""
        SELECT DEST, CAST(year({_DAY_SQL}) AS INTEGER) AS FL_YEAR,
               count(1) AS NUM_CANCELLED_FLIGHT
        FROM ({_FLIGHTS_SQL}) WHERE CANCELLED = 1 AND year({_DAY_SQL}) IS NOT NULL
        GROUP BY DEST, year({_DAY_SQL}) ORDER BY DEST, FL_YEAR
    """,
    "flagged_detail": f"""
        SELECT id, DEST, DEST_CITY_NAME, strftime({_DAY_SQL}, '%Y-%m-%d') AS FL_DATE,
               ORIGIN, CANCELLED
        FROM ({_FLIGHTS_SQL})
        WHERE year({_DAY_SQL}) = {FLIGHT_YEAR} AND CANCELLED = 1 AND DEST_CITY_NAME = '{CITY}'
        ORDER BY FL_DATE DESC, id
    """,
    "parsed_date_column": """
        SELECT *, CAST(try_strptime(InvoiceDate, '%d-%m-%Y') AS DATE) AS date_parsed
        FROM (SELECT o_orderkey AS InvoiceNo, o_custkey AS CustomerID,
                     strftime(o_orderdate, '%d-%m-%Y') AS InvoiceDate FROM orders)
    """,
}
