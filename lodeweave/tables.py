"""Reading the tables of a data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The parquet table ``name`` of ``folder``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def micros(column: Column | str) -> Column:
    """Microseconds since 1970 of a time; one without zone is in the session's zone, which is UTC. Null stays null."""
    return F.unix_micros((F.col(column) if isinstance(column, str) else column).cast("timestamp"))
