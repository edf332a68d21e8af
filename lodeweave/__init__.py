"""Spark-first analytics over timestamped news and market feeds.

Every operator is a function from DataFrames to a DataFrame; nothing is
executed until the caller acts on the result, except where a docstring says so.
"""

__version__ = "0.1.0"
