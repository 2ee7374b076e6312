"""The query catalogue over the driver's tables."""
