"""tracewright: security-log analytics and normalisation on Spark DataFrames."""

__version__ = "0.1.0"
