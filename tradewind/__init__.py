"""Commerce analytics on Spark: cleaning, star schema, table maintenance, data quality."""

__version__ = "0.1.0"
