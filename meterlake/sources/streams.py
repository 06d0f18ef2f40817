"""Streams over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Spark passes over files older than a week by default, among them restored and copied ones.
ANY_AGE = "36500d"


def table_stream(
    spark: SparkSession, path: str, schema: StructType, max_files: int | None = None
) -> DataFrame:
    """New files of a parquet table. Files of a replaced partition count as new."""
    reader = spark.readStream.schema(schema).option("maxFileAge", ANY_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def csv_stream(
    spark: SparkSession, path: str, schema: StructType, max_files: int | None = None
) -> DataFrame:
    """CSV file stream for feeds whose header never changes, with the file path as a column."""
    reader = spark.readStream.schema(schema).option("header", True).option("maxFileAge", ANY_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path).selectExpr("*", "_metadata.file_path AS source_file_name")
