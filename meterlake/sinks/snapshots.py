"""Whole-table rewrites for dimensions.

Every rewrite goes to a new ``v=<n>`` folder and readers take the newest folder that has
Spark's success marker. A rewrite may therefore read the table it replaces, and one that
dies half-way leaves the previous content in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterlake.sinks import files
from meterlake.sinks.counters import Flags, Watch, save_counters

_PREFIX = "v="


def _versions(spark: SparkSession, path: str) -> list[int]:
    folders = [n for n in files.names(spark, path) if n.startswith(_PREFIX)]
    return sorted(int(name.removeprefix(_PREFIX)) for name in folders)


def _complete(spark: SparkSession, path: str) -> list[int]:
    marker = "{}/{}{}/_SUCCESS"
    return [v for v in _versions(spark, path) if files.exists(spark, marker.format(path, _PREFIX, v))]


def snapshot_exists(spark: SparkSession, path: str) -> bool:
    return bool(_complete(spark, path))


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    complete = _complete(spark, path)
    if not complete:
        raise FileNotFoundError(f"no complete snapshot under {path}")
    return spark.read.parquet(f"{path}/{_PREFIX}{complete[-1]}")


def refresh(df: DataFrame, path: str, keep: int = 2, flags: Flags | None = None) -> None:
    """Replace the table's content; the last ``keep`` contents stay for running readers.

    The rows, and those that meet each of ``flags``, are counted as they are written.
    """
    spark = df.sparkSession
    version = max(_versions(spark, path), default=0) + 1
    watch = Watch(flags)
    watch.on(df).write.mode("errorifexists").parquet(f"{path}/{_PREFIX}{version}")
    save_counters(spark, path, {"all": watch.counts}, keep_others=False)
    for old in _complete(spark, path)[:-keep]:
        files.remove(spark, f"{path}/{_PREFIX}{old}")


def publish(spark: SparkSession, staged: str, path: str, keep: int = 2) -> None:
    """Make a finished, staged folder the table's newest content, by moving it.

    Called again after it has moved, it changes nothing.
    """
    if files.exists(spark, f"{staged}/_SUCCESS"):
        version = max(_versions(spark, path), default=0) + 1
        files.move(spark, staged, f"{path}/{_PREFIX}{version}")
    for old in _complete(spark, path)[:-keep]:
        files.remove(spark, f"{path}/{_PREFIX}{old}")


def create_snapshot_if_missing(df: DataFrame, path: str) -> None:
    if not snapshot_exists(df.sparkSession, path):
        refresh(df, path)
