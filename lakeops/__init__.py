"""lakeops: data jobs for tables and streams, written with Spark DataFrames, SQL and Structured Streaming."""

__version__ = "0.1.0"
