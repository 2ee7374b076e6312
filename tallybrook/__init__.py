"""Analytics and ingestion jobs for plain Spark: operators, sources, sinks, streams."""
