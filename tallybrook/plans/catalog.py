"""All queries by name, and the SQL their results are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallybrook.plans import dirty_text, flights, sales, storage, streams, trends

Query = Callable[[SparkSession, str], DataFrame]

FLAGSHIP = "agg_country_year"

_MODULES = (sales, dirty_text, flights, trends, storage, streams)

ORACLES: dict[str, str] = {
    name: sql for module in _MODULES for name, sql in module.ORACLES.items()
}
QUERIES: dict[str, Query] = {
    name: getattr(module, name) for module in _MODULES for name in module.ORACLES
}
