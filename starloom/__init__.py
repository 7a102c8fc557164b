"""Change-data-capture logs to a trustworthy star schema, on Spark DataFrames."""

__version__ = "0.1.0"
