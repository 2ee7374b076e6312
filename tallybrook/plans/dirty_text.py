"""Filters on survey answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.operators import size_at_least, size_in_form
from tallybrook.plans import tables
from tallybrook.sources import run_sql

LEAST_SIZE = 20


def regex_size_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers with a large enough number, by a CTE over a frame."""
    return run_sql(
        spark,
        r"""
        WITH sized AS (
            SELECT answer, state, no_employees,
                   try_cast(regexp_extract(no_employees, r'\d+', 0) AS INT) AS size
            FROM {survey}
        )
        SELECT answer, state, no_employees FROM sized WHERE size >= :least
        """,
        args={"least": LEAST_SIZE},
        survey=tables.survey(spark, sf_dir),
    )


def answers_per_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers and the largest number per state, of those with a large enough one."""
    return run_sql(
        spark,
        r"""
        WITH sized AS (
            SELECT state, try_cast(regexp_extract(no_employees, r'\d+', 0) AS INT) AS size
            FROM {survey}
        )
        SELECT state, count(*) AS num_answers, max(size) AS largest
        FROM sized WHERE size >= :least GROUP BY state
        """,
        args={"least": LEAST_SIZE},
        survey=tables.survey(spark, sf_dir),
    )


def regex_size_filter_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the DataFrame operator."""
    return size_at_least(tables.survey(spark, sf_dir), "no_employees", LEAST_SIZE)


def regex_or_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers in either of two forms, each with its own least number."""
    text = F.col("no_employees")
    forms = [
        (text.like("Brand#1%"), 15),
        (F.regexp_like(text, F.lit(r"^Brand#2\d$")), 23),
    ]
    return size_in_form(tables.survey(spark, sf_dir), "no_employees", forms)


_SURVEY_SQL = r"""
    SELECT p_partkey AS answer, p_type AS state, p_brand AS no_employees,
           try_cast(regexp_extract(p_brand, '\d+', 0) AS INTEGER) AS size
    FROM part
"""

_LARGE_SQL = f"""
    SELECT answer, state, no_employees FROM ({_SURVEY_SQL}) WHERE size >= {LEAST_SIZE}
"""

ORACLES = {
    "regex_size_filter": _LARGE_SQL,
    "regex_size_filter_df": _LARGE_SQL,
    "answers_per_state": f"""
        SELECT state, count(*) AS num_answers, max(size) AS largest
        FROM ({_SURVEY_SQL}) WHERE size >= {LEAST_SIZE} GROUP BY state
    """,
    "regex_or_filter": rf"""
        SELECT answer, state, no_employees FROM ({_SURVEY_SQL})
        WHERE (no_employees LIKE 'Brand#1%' AND size >= 15)
           OR (regexp_matches(no_employees, '^Brand#2\d$') AND size >= 23)
    """,
}
