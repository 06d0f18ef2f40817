"""Silver to gold facts, date by date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterlake.plans.facts import fact_daily_summary, fact_meter_readings
from meterlake.plans.quality import DAILY, FACT, UNIQUE, fact_summary
from meterlake.sinks.counters import Flags
from meterlake.sinks.snapshots import read_snapshot
from meterlake.sinks.tables import overwrite_partitions
from meterlake.streaming.runners import stream_apply
from meterlake.streaming.silver import (
    READING_DATE,
    grow_table_schema,
    replace_dates,
    stored_dates,
    stored_stream,
    touched_dates,
)


def _follow_dates(
    spark: SparkSession,
    source: str,
    target: str,
    build: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    max_files: int | None,
    flags: Flags | None,
    unique: str,
    after: Callable[[DataFrame], None] = lambda rows: None,
) -> None:
    """Rebuild the target's dates that changed in the source, from all source rows of those dates."""

    def rebuild(batch: DataFrame, _: int) -> dict:
        dates: set[dt.date | None] = touched_dates(batch, READING_DATE)
        rows = stored_dates(spark, source, READING_DATE, dates)
        counts = replace_dates(build(rows), target, READING_DATE, dates, flags, unique)
        after(stored_dates(spark, target, READING_DATE, dates))
        return counts

    stream = stored_stream(spark, source, max_files).select(READING_DATE)
    stream_apply(stream, rebuild, checkpoint)


def gold_fact_readings(
    spark: SparkSession,
    enriched: str,
    dims: dict[str, str],
    target: str,
    checkpoint: str,
    run_id: str,
    max_files: int | None = None,
    flags: Flags | None = None,
) -> None:
    """``dims`` holds the snapshot paths of dim_date, dim_building, dim_site, dim_meter_type
    and dim_time_of_day. Beside the fact a summary of each date is kept for the checks."""

    def build(rows: DataFrame) -> DataFrame:
        names = ("dim_date", "dim_building", "dim_site", "dim_meter_type", "dim_time_of_day")
        return fact_meter_readings(rows, *[read_snapshot(spark, dims[n]) for n in names], run_id)

    def summarise(rows: DataFrame) -> None:
        short = fact_summary(rows)
        grow_table_schema(spark, f"{target}.summary", short.schema)
        overwrite_partitions(short, f"{target}.summary", READING_DATE)

    _follow_dates(spark, enriched, target, build, checkpoint, max_files, flags, UNIQUE[FACT], summarise)


def gold_fact_daily(
    spark: SparkSession,
    fact: str,
    dim_building: str,
    target: str,
    checkpoint: str,
    max_files: int | None = None,
    flags: Flags | None = None,
) -> None:
    def build(rows: DataFrame) -> DataFrame:
        return fact_daily_summary(rows, read_snapshot(spark, dim_building))

    _follow_dates(spark, fact, target, build, checkpoint, max_files, flags, UNIQUE[DAILY])
