"""Path tables in parquet: append, create, and partition replacement that can be repeated."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from meterlake.sinks import files
from meterlake.sinks.counters import Watch

_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def table_exists(spark: SparkSession, path: str) -> bool:
    """True once a write to the path has completed (or a partition has been added)."""
    return any(not name.startswith((".", "_")) for name in files.names(spark, path))


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a path table. Without a schema the schemas of all its files are merged."""
    reader = spark.read
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", True)
    return reader.parquet(path)


def read_partitions(
    spark: SparkSession, path: str, schema: StructType, column: str, values: Iterable
) -> DataFrame:
    """Rows of some partitions. Only their folders are listed, not the files of the whole table."""
    wanted = {f"{column}={_NULL_PARTITION if value is None else value}" for value in values}
    folders = [f"{path}/{name}" for name in files.names(spark, path) if name in wanted]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def _watched(df: DataFrame, watch: Watch | None) -> DataFrame:
    return watch.on(df) if watch else df


def _layout(df: DataFrame, partition_by: str | None, watch: Watch | None = None):
    """Gather each partition's rows into well-sized files.

    REBALANCE is re-planned at run time: a small partition becomes one file and a huge one
    is split over many tasks, so one hot date neither floods a task nor leaves crumbs.
    """
    if partition_by is None:
        return _watched(df, watch).write
    return _watched(df.hint("rebalance", partition_by), watch).write.partitionBy(partition_by)


def append(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Add rows. Columns the table lacks so far read as null in its older rows."""
    _layout(df, partition_by).mode("append").parquet(path)


def create_if_missing(df: DataFrame, path: str) -> None:
    """Write the table only if nothing is there yet."""
    df.write.mode("ignore").parquet(path)


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: str, gather: bool = True, watch: Watch | None = None
) -> None:
    """Replace exactly the partitions that occur in ``df``; repeating it changes nothing.

    Without ``gather`` tasks write what they hold, which saves a shuffle where all rows are of
    one partition. ``df`` must not read ``path``; see :func:`restate_partitions` for that.
    ``watch`` counts the rows as they are written.
    """
    layout = _layout(df, partition_by, watch) if gather else _watched(df, watch).write.partitionBy(partition_by)
    writer = layout.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def restate_partitions(
    df: DataFrame, path: str, partition_by: str, stage: str, watch: Watch | None = None
) -> None:
    """Replace partitions of ``path`` with rows that were computed from ``path`` itself.

    The rows are first written in full to ``stage``. A failure while partitions are being
    swapped is repaired by calling again with the same stage, which then skips the
    computation, so rows of a half-swapped partition cannot be lost.
    """
    spark = df.sparkSession
    if not files.exists(spark, f"{stage}/_SUCCESS"):
        df.write.mode("overwrite").parquet(stage)
    overwrite_partitions(spark.read.schema(df.schema).parquet(stage), path, partition_by, watch=watch)
    files.remove(spark, stage)
