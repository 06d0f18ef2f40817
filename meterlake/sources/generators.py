"""Generated inputs: calendar days, hours of the day, literal rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    days = (end - start).days + 1
    return spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date"))


def hour_spine(spark: SparkSession) -> DataFrame:
    return spark.range(24).select(F.col("id").cast("int").alias("hour"))


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)
